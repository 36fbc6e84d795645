"""Shape, signal and magnitude columns of detections."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SATURATION_ADU = 60_000
EDGE_FRACTION = 0.05


def fwhm_px(a: Column, b: Column) -> Column:
    """Full width at half maximum of the mean Gaussian of a detection's half axes."""
    return 2e0 * F.sqrt(2e0 * F.log(F.lit(2e0)) * (a * a + b * b) / 2e0)


def elongation(a: Column, b: Column, variant: str = "extraction") -> Column:
    """a/b. A flat detection: `extraction` divides by 1e-6, `quality` gives 1, `difference` floors b at 0.001."""
    if variant == "difference":
        return a / F.greatest(b, F.lit(1e-3))
    flat = a / 1e-6 if variant == "extraction" else F.lit(1e0)
    return F.when(b <= 0, flat).otherwise(a / F.when(b > 0, b))


def saturated(peak: Column, background: Column) -> Column:
    return peak + background >= SATURATION_ADU


def ratio(value: Column, noise: Column) -> Column:
    """value/noise where the noise is positive; may be negative."""
    return F.when(noise > 0, value / F.when(noise > 0, noise))


def difference_snr(flux: Column, rms: Column, npix: Column) -> Column:
    return F.when(npix > 0, flux / (rms * F.sqrt(F.greatest(npix, F.lit(1)).cast("double")))).otherwise(0e0)


def near_edge(x: Column, y: Column, width: Column, height: Column, fraction: float = EDGE_FRACTION) -> Column:
    m = F.lit(float(fraction))
    return (x < m * width) | (x > width - m * width) | (y < m * height) | (y > height - m * height)


def edge_flag(x: Column, y: Column, width: Column, height: Column, margin: int = 10) -> Column:
    return (x < margin) | (x > width - margin) | (y < margin) | (y > height - margin)


def magnitudes(flux: Column, err: Column, zero_point: Column, usable: Column) -> dict[str, Column]:
    """Instrumental and calibrated magnitudes; `mag` is the calibrated one or null, never the instrumental one."""
    inst = F.when(usable & (flux > 0), -2.5e0 * F.log10(F.when(flux > 0, flux)))
    return {
        "mag_instrumental": inst,
        "mag_err": F.when(usable & (flux > 0), 1.0857e0 * err / F.when(flux > 0, flux)),
        "snr": F.when(usable, ratio(flux, err)),
        "mag_calibrated": inst + zero_point,
        "mag": inst + zero_point,
        "calibrated": inst.isNotNull() & zero_point.isNotNull(),
    }
