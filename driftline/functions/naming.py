"""Column names made from thresholds."""

from __future__ import annotations

STATISTICS = ("mean", "min", "max", "p05", "p95", "variance")
DAY_BASED = ("days_above", "days_below", "degree_days_above", "max_spell_above")


def threshold_label(x: float) -> str:
    text = f"{abs(x):g}".replace(".", "p")
    return ("neg" if x < 0 else "") + text + "c"


def band_label(low: float, high: float) -> str:
    return f"{threshold_label(low)}_{threshold_label(high)}"


def columns_for(thresholds: dict) -> list[tuple[str, str]]:
    """(name, type) of every feature that the thresholds ask for, after the statistics."""
    out = []
    for kind in ("days_above", "days_below", "degree_days_above"):
        out += [(f"{kind}_{threshold_label(t)}", "double") for t in thresholds.get(kind, ())]
    for t in thresholds.get("max_spell_above", ()):
        out += [(f"max_spell_above_{threshold_label(t)}_days", "double"), (f"max_spell_above_{threshold_label(t)}_gap_interrupted", "boolean")]
    out += [(f"frac_in_band_{band_label(a, b)}", "double") for a, b in thresholds.get("time_in_band", ())]
    return out


def feature_columns(features: dict) -> list[tuple[str, str]]:
    """Statistics and the union over all parameters, in first-appearance order, whatever the data hold."""
    seen = {s: "double" for s in STATISTICS}
    for entry in features.values():
        seen |= dict(columns_for(entry or {}))
    return list(seen.items())


def without_day_based(columns: list[tuple[str, str]]) -> list[tuple[str, str]]:
    return [c for c in columns if not c[0].startswith(DAY_BASED)]


def anomaly_columns(measured: list[str]) -> list[str]:
    return ["baseline_years", *(f"{m}_anom" for m in measured)]
