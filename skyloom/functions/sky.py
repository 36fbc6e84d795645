"""Spherical geometry as column expressions. Angles are degrees, separations arcseconds; nulls give nulls."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Angle = Column | float


def _c(x: Column | str | float) -> Column:
    return x if isinstance(x, Column) else F.col(x) if isinstance(x, str) else F.lit(float(x))


def separation_arcsec(ra1, dec1, ra2, dec2) -> Column:
    """Great-circle distance by the haversine formula."""
    ra1, dec1, ra2, dec2 = map(_c, (ra1, dec1, ra2, dec2))
    d_dec, d_ra = F.sin(F.radians(dec2 - dec1) / 2e0), F.sin(F.radians(ra2 - ra1) / 2e0)
    h = d_dec * d_dec + F.cos(F.radians(dec1)) * F.cos(F.radians(dec2)) * d_ra * d_ra
    return 2e0 * F.degrees(F.asin(F.sqrt(F.least(F.lit(1e0), h)))) * 3.6e3


def rounded(arcsec, digits: int) -> Column:
    """A separation to so many decimals by arithmetic alone (F.round makes a decimal number of every value)."""
    return F.floor(_c(arcsec) * float(10**digits) + 0.5) / float(10**digits)


def wrap180(angle) -> Column:
    """The same angle in (-180, 180]."""
    return -(F.pmod(-_c(angle) + 180e0, F.lit(360e0)) - 180e0)


def tile(angle) -> Column:
    """The nearest multiple of a tenth of a degree; halves go to the even one."""
    return F.rint(_c(angle) / 1e-1) * 1e-1


def unit_vector(ra, dec) -> tuple[Column, Column, Column]:
    ra, dec = F.radians(_c(ra)), F.radians(_c(dec))
    return F.cos(dec) * F.cos(ra), F.cos(dec) * F.sin(ra), F.sin(dec)


def propagated(ra, dec, pmra, pmdec, epoch, ref_epoch) -> tuple[Column, Column]:
    """Position moved by proper motion (mas a year) to an epoch in Julian years; unmoved where something is unknown."""
    ra, dec, pmra, pmdec = map(_c, (ra, dec, pmra, pmdec))
    dt = _c(epoch) - F.coalesce(_c(ref_epoch), F.lit(2016e0))
    cosine = F.cos(F.radians(dec))
    moves = pmra.isNotNull() & pmdec.isNotNull() & dt.isNotNull() & (dt != 0) & (F.abs(cosine) >= 1e-9)
    return F.when(moves, ra + pmra / 1e3 / 3.6e3 * dt / cosine).otherwise(ra), F.when(moves, dec + pmdec / 1e3 / 3.6e3 * dt).otherwise(dec)


def pointing_error(ra_mount, dec_mount, ra_solved, dec_solved) -> dict[str, Column]:
    """Total, and signed components in RA (times the cosine of the mount's declination) and Dec; all null together."""
    ra_m, dec_m, ra_s, dec_s = map(_c, (ra_mount, dec_mount, ra_solved, dec_solved))
    known = ra_m.isNotNull() & dec_m.isNotNull() & ra_s.isNotNull() & dec_s.isNotNull()
    d_ra = F.pmod(ra_s - ra_m + 180e0, F.lit(360e0)) - 180e0
    made = {
        "pointing_error_arcsec": separation_arcsec(ra_m, dec_m, ra_s, dec_s),
        "pointing_error_ra_arcsec": d_ra * F.cos(F.radians(dec_m)) * 3.6e3,
        "pointing_error_dec_arcsec": (dec_s - dec_m) * 3.6e3,
    }
    return {k: F.when(known, v) for k, v in made.items()}


def pixel_to_sky(x, y, wcs: str = "wcs") -> tuple[Column, Column]:
    """Tangent-plane projection; wcs names a struct of crpix1, crpix2, crval1, crval2, cd11, cd12, cd21, cd22 (1-based pixels)."""
    w = lambda f: F.col(f"{wcs}.{f}")
    dx, dy = _c(x) - w("crpix1"), _c(y) - w("crpix2")
    xi, eta = F.radians(w("cd11") * dx + w("cd12") * dy), F.radians(w("cd21") * dx + w("cd22") * dy)
    dec0 = F.radians(w("crval2"))
    down = F.cos(dec0) - eta * F.sin(dec0)
    ra = F.pmod(w("crval1") + F.degrees(F.atan2(xi, down)), F.lit(360e0))
    dec = F.degrees(F.atan2(F.sin(dec0) + eta * F.cos(dec0), F.sqrt(down * down + xi * xi)))
    return ra, dec


def sky_to_pixel(ra, dec, wcs: str = "wcs") -> tuple[Column, Column]:
    """The inverse of pixel_to_sky; null on the far hemisphere or for a singular matrix."""
    w = lambda f: F.col(f"{wcs}.{f}")
    d_ra, dec0, dec1 = F.radians(_c(ra) - w("crval1")), F.radians(w("crval2")), F.radians(_c(dec))
    den = F.sin(dec0) * F.sin(dec1) + F.cos(dec0) * F.cos(dec1) * F.cos(d_ra)
    xi = F.degrees(F.cos(dec1) * F.sin(d_ra) / den)
    eta = F.degrees((F.cos(dec0) * F.sin(dec1) - F.sin(dec0) * F.cos(dec1) * F.cos(d_ra)) / den)
    det = w("cd11") * w("cd22") - w("cd12") * w("cd21")
    fine = (den > 1e-9) & (det != 0)
    return (
        F.when(fine, w("crpix1") + (w("cd22") * xi - w("cd12") * eta) / F.when(det != 0, det)),
        F.when(fine, w("crpix2") + (w("cd11") * eta - w("cd21") * xi) / F.when(det != 0, det)),
    )


def plate_scale_arcsec(wcs: str = "wcs") -> Column:
    return F.sqrt(F.col(f"{wcs}.cd11") * F.col(f"{wcs}.cd11") + F.col(f"{wcs}.cd21") * F.col(f"{wcs}.cd21")) * 3.6e3


def position_angle(ra0, dec0, ra_north, dec_north) -> Column:
    """Angle of the offset to a point, from North over East, in (-180, 180]."""
    dx = wrap180(_c(ra_north) - _c(ra0)) * F.cos(F.radians(_c(dec0)))
    return F.degrees(F.atan2(dx, _c(dec_north) - _c(dec0)))


def rotation(pa_new, pa_old, ignore_below: float = 2.0) -> Column:
    """The shortest signed angle between two position angles; 0 where it is too small to matter."""
    delta = wrap180(_c(pa_new) - _c(pa_old))
    return F.when(F.abs(delta) < ignore_below, 0e0).otherwise(delta)


def shift_label(arcsec) -> Column:
    """A separation for people: arcseconds, arcminutes or degrees."""
    s = _c(arcsec)
    return F.when(s < 60, F.format_string("%.2f\u2033", s)).when(s < 3600, F.format_string("%.2f\u2032", s / 60e0)).when(s.isNotNull(), F.format_string("%.3f\u00b0", s / 3600e0))


def gap_label(hours) -> Column:
    """A time gap for people: minutes, hours or days."""
    h = _c(hours)
    return F.when(h < 1, F.format_string("%.0fmin", h * 60e0)).when(h < 24, F.format_string("%.1fhr", h)).when(h.isNotNull(), F.format_string("%.1fd", h / 24e0))


def motion_label(arcsec, hours) -> Column:
    """Shift, and gap and velocity where the gap is known and not 0."""
    s, h = _c(arcsec), _c(hours)
    shift = F.concat(F.lit("\u0394"), shift_label(s))
    speed = F.format_string(" (%.1f\u2033/hr)", s / F.when(h > 0, h))
    return F.when(h > 0, F.concat(shift, F.lit(" in "), gap_label(h), speed)).otherwise(shift)
