"""Messages and routes decided by row values."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def score_route(score: Column, passed: Column, failed: Column, above: int = 5) -> Column:
    """``passed`` where the integer part of the score is above the bound, else ``failed``."""
    return F.when(score.try_cast("int") > F.lit(above), passed).otherwise(failed)


def over_limit_message(meter: Column, used: Column, limit: float) -> Column:
    """The alert text of a reading above the limit."""
    return F.concat(F.lit("DANGER: Meter "), meter, F.lit(" with "), used.cast("string"),
                    F.lit(f"kWh exceeded the limit of {limit}kWh"))


def level(value: Column, alert_above: float) -> Column:
    """``alert``, ``zero`` or ``normal``."""
    return (F.when(value > alert_above, F.lit("alert"))
            .when(value == 0.0, F.lit("zero"))
            .otherwise(F.lit("normal")))
