"""Normalisation of header texts: objects, filters, frame types, file names, sexagesimal angles, times."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN = "_UNKNOWN"

# Spellings of filters (case-folded) by their short form.
FILTERS = {
    "L": ["luminance", "lum", "l", "clear", "clr"],
    "R": ["red", "r"],
    "G": ["green", "g"],
    "B": ["blue", "b"],
    "Ha": ["ha", "h-alpha", "halpha", "hydrogen-alpha", "h_alpha", "hydrogen alpha"],
    "OIII": ["oiii", "o3", "o-iii", "oxygen-iii", "oxygen iii", "[oiii]"],
    "SII": ["sii", "s2", "s-ii", "sulfur-ii", "sulfur ii", "[sii]"],
    "NII": ["nii", "n2", "n-ii", "nitrogen-ii", "[nii]"],
    "U": ["u"],
    "V": ["v"],
    "I": ["i"],
    "u'": ["u'"],
    "g'": ["g'"],
    "r'": ["r'"],
    "i'": ["i'"],
    "z'": ["z'"],
}
# Spellings of frame types.
FRAME_TYPES = {
    "Light": ["light", "light frame", "lightframe", "object", "science"],
    "Dark": ["dark", "dark frame", "darkframe"],
    "Flat": ["flat", "flat frame", "flatframe", "flat field", "skyflat", "domeflat"],
    "Bias": ["bias", "bias frame", "biasframe", "zero", "offset"],
}
# Words that end the object's part of a file name.
STOP_WORDS = ["light", "dark", "flat", "bias", "l", "d", "f", "b", "lightframe", "darkframe", "flatframe", "biasframe", "science", "calibration", "object"]
# Catalogue prefixes that are written in capitals before their number.
PREFIXES = ["NGC", "IC", "UGC", "PGC", "MCG", "Mrk", "Arp", "VCC", "ESO", "UGCA"]
# Emission-line filters.
NARROWBAND = ["Ha", "OIII", "SII", "NII"]


def _vocabulary(words: dict[str, list[str]]) -> Column:
    return F.create_map(*[F.lit(x) for short, spellings in words.items() for s in spellings for x in (s, short)])


def _blank_to_null(raw: Column) -> Column:
    return F.when(F.trim(raw) != "", F.trim(raw))


def object_name(raw: Column) -> Column:
    """M51, C14, SH2-155, Abell1, NGC1234; other names with `_` for blanks and without odd characters."""
    s = F.trim(raw)
    number = lambda prefix: F.regexp_extract(s, rf"(?i)^{prefix}[_\s\-]*(\d+)$", 1)
    listed = rf"(?i)^({'|'.join(PREFIXES)})[_\s\-]*(\d+(?:[_\s\-]\d+)*)$"
    cases = [(number("M"), "M"), (number("C"), "C"), (number("SH2?"), "SH2-"), (number("ABELL"), "Abell")]
    free = F.regexp_replace(F.regexp_replace(F.replace(s, F.lit(" "), F.lit("_")), r"[^A-Za-z0-9_\-+]", ""), "_+", "_")
    free = F.regexp_replace(free, "^_+|_+$", "")
    out = F.when(s.isNull() | (s == ""), UNKNOWN)
    for digits, prefix in cases:
        out = out.when(digits != "", F.concat(F.lit(prefix), digits))
    out = out.when(s.rlike(listed), F.concat(F.upper(F.regexp_extract(s, listed, 1)), F.regexp_replace(F.regexp_extract(s, listed, 2), r"[_\s\-]", "")))
    return out.when(free == "", UNKNOWN).otherwise(free)


def filter_name(raw: Column) -> Column:
    """The short form; a trailing `filter` may be left out; unknown names stay, blank ones are null."""
    s = _blank_to_null(raw)
    words = _vocabulary(FILTERS)
    return F.coalesce(F.try_element_at(words, F.lower(s)), F.try_element_at(words, F.lower(F.regexp_replace(s, r"(?i)\s*filter$", ""))), s)


def frame_type(raw: Column) -> Column:
    s = _blank_to_null(raw)
    return F.coalesce(F.try_element_at(_vocabulary(FRAME_TYPES), F.lower(s)), s)


def is_narrowband(raw: Column) -> Column:
    return F.coalesce(filter_name(raw).isin(NARROWBAND), F.lit(False))


def object_from_filename(name: Column) -> Column:
    """The parts before the first frame type or number, as an object name."""
    parts = F.split(F.regexp_replace(name, r"(?i)\.(fits|fit)$", ""), "_")
    stops = F.transform(parts, lambda p: F.lower(p).isin(STOP_WORDS) | p.rlike(r"^\d+$"))
    first = F.array_position(stops, True)
    return object_name(F.array_join(F.when(first > 0, F.slice(parts, F.lit(1), F.greatest(first - 1, F.lit(0)).cast("int"))).otherwise(parts), "_"))


def file_name(obj: Column, kind: Column, filt: Column, exptime: Column, obs_time: Column, sequence: Column) -> Column:
    """Object_Type[_Filter for Light][_exposure]_time[_sequence].fits; null without a time."""
    name = F.when(F.coalesce(obj, F.lit("")) == "", UNKNOWN).otherwise(obj)
    exposure = F.when(exptime == F.floor(exptime), F.floor(exptime).cast("string")).otherwise(F.format_string("%.1f", exptime))
    time = F.regexp_replace(F.replace(obs_time, F.lit(":"), F.lit("-")), r"\.\d+", "")
    parts = [name, F.when(kind != "", kind), F.when((kind == "Light") & (filt != ""), filt), F.when(exptime.isNotNull(), exposure), time, F.when(sequence.isNotNull(), F.format_string("%03d", sequence))]
    return F.when(obs_time != "", F.concat(F.concat_ws("_", *parts), F.lit(".fits")))


def safe_name(raw: Column, keep_dots: bool = True, collapse: bool = True) -> Column:
    """Fit for a file system; the two variants differ in dots and in runs of `_`."""
    out = F.regexp_replace(F.replace(raw, F.lit(" "), F.lit("_")), r"[^A-Za-z0-9_\-+.]" if keep_dots else r"[^A-Za-z0-9_\-+]", "")
    out = F.regexp_replace(out, "_+", "_") if collapse else out
    out = F.regexp_replace(out, "^_+|_+$", "")
    return F.when(F.coalesce(out, F.lit("")) == "", UNKNOWN).otherwise(out)


def degrees_of(raw: Column, hours: bool) -> Column:
    """Sexagesimal text (a blank or a colon inside) or a plain number as degrees; `-00 30 00` keeps its sign."""
    s = F.trim(raw)
    parts = F.split(F.regexp_replace(s, r"^[+-]", ""), r"[\s:]+")
    part = lambda k: F.coalesce(F.try_element_at(parts, F.lit(k)).try_cast("double"), F.lit(0e0))
    value = part(1) + part(2) / 6e1 + part(3) / 3.6e3
    value = F.when(s.startswith("-"), -value).otherwise(value) * (15e0 if hours else 1e0)
    wellformed = s.rlike(r"^[+-]?\d+(\.\d*)?([\s:]+\d+(\.\d*)?){1,2}$")
    return F.when(s.rlike(r"[\s:]"), F.when(wellformed, value)).otherwise(s.try_cast("double"))


def observed_at(date_obs: Column, time_obs: Column, mjd: Column) -> Column:
    """A timestamp (without a zone: UTC) from the first of the three that is there and can be read."""
    formats = ["yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "yyyy-MM-dd'T'HH:mm:ss.SSS", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm", "yyyy-MM-dd"]
    read = lambda c: [F.to_timestamp_ntz(F.when(c.rlike(p), c), F.lit(f)) for f, p in zip(formats, [r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{6}$", r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{3}$", r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d$", r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d$", r"^\d{4}-\d\d-\d\dT\d\d:\d\d$", r"^\d{4}-\d\d-\d\d$"], strict=True)]
    from_mjd = F.timestamp_micros(((mjd.try_cast("double") - 40587) * 86_400_000_000).cast("long")).cast("timestamp_ntz")
    return reduce(lambda a, b: F.coalesce(a, b), [*read(F.trim(date_obs)), *read(F.trim(time_obs)), from_mjd])


def plate_scale(pixscale: Column, pixel_um: Column, focal_mm: Column) -> Column:
    """Arcseconds a pixel: the header's own value from 0.01 to 200, else from pixel size and focal length."""
    return F.coalesce(F.when(pixscale.between(0.01, 200), pixscale), F.when((focal_mm > 0) & (pixel_um > 0), 206265e0 * (pixel_um / 1e3) / F.when(focal_mm > 0, focal_mm)))


def field_of_view(width: Column, height: Column, pixel_um: Column, binning_x: Column, binning_y: Column, focal_mm: Column, solved: Column) -> Column:
    """Degrees: the solved value, else from the larger side; pixels are 3.76 µm unless told otherwise."""
    pixel = F.coalesce(F.when(pixel_um > 0, pixel_um), F.lit(3.76e0)) * F.greatest(F.coalesce(binning_x, F.lit(1)), F.coalesce(binning_y, F.lit(1)))
    computed = F.when((focal_mm > 0) & width.isNotNull() & height.isNotNull(), F.greatest(width, height) * 206265e0 * (pixel / 1e3) / F.when(focal_mm > 0, focal_mm) / 3.6e3)
    return F.coalesce(solved, computed)


# Types whose sources move.
MOVING = ["ASTEROID", "COMET", "MOVING_UNKNOWN", "SPACE_DEBRIS"]
ALERTS = ["SUPERNOVA_CANDIDATE", "MOVING_UNKNOWN", "SPACE_DEBRIS", "UNKNOWN"]


def moving_label(kind: Column, designation: Column, source_id: Column) -> Column:
    """TYPE (designation), or the one of both that there is; moving types fall back to the source's id."""
    name = F.coalesce(F.when(designation != "", designation), F.when(kind.isin(MOVING), source_id))
    return F.when(kind.isNotNull() & name.isNotNull(), F.concat(kind, F.lit(" ("), name, F.lit(")"))).otherwise(F.coalesce(kind, name))


def label_parts(label: Column) -> tuple[Column, Column]:
    """The type and the designation with its parentheses, null where there is none."""
    named = r"^(.*\S)\s+(\(.+\))$"
    return F.when(label.rlike(named), F.regexp_extract(label, named, 1)).otherwise(label), F.when(label.rlike(named), F.regexp_extract(label, named, 2))


def presentation(n_epochs: Column, kind: Column) -> Column:
    """How a source is shown: one epoch, a track of a moving type, or stamps."""
    return F.when(n_epochs <= 1, "before_after").when(kind.isin(MOVING), "track").otherwise("stamp_strip")


def object_class(object_type: Column) -> dict[str, Column]:
    """Variable, binary, galaxy: by parts of the type's text, wherever they stand in it; null is none of them."""
    holds = lambda words: F.coalesce(reduce(lambda a, b: a | b, [object_type.contains(w) for w in words]), F.lit(False))
    return {"variable": holds(["V*", "RR", "Cep", "BY", "RS", "Ell", "bL"]), "binary": holds(["**", "EB", "SB"]), "galaxy": holds(["G", "SFG", "AGN", "GiG"])}
