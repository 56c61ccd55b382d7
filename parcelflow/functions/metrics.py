"""Delivery metric expressions of the ETL and small business-key helpers.

Numbers stay DECIMAL end to end. The ETL's derived measures round half to
even (``bround``), the SQL reports and totals round half up (``round``):
that is the split between the reference's pandas and SQL steps.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the delivery economics.
FUEL_PRICE_PER_LITER = 5000
BASE_REVENUE = 20000
REVENUE_PER_KG = 500
ON_TIME_LIMIT_MINUTES = 30
MIN_PACKAGE_WEIGHT_EXCLUSIVE = 0
MAX_PACKAGE_WEIGHT_EXCLUSIVE = 10000
TOLL_PER_BAND = 15000
TOLL_BAND_KM = 100


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def round_even(col: Column | str, scale: int = 2) -> Column:
    return F.bround(_c(col), scale)


def round_up(col: Column | str, scale: int = 2) -> Column:
    return F.round(_c(col), scale)


def clip_lower_zero(col: Column | str) -> Column:
    """``max(0, x)``; null stays null."""
    c = _c(col)
    return F.when(c.isNull(), F.lit(None)).otherwise(F.greatest(c, F.lit(0)))


def zero_to_null(col: Column | str) -> Column:
    return F.nullif(_c(col), F.lit(0))


def fill_zero(col: Column | str) -> Column:
    return F.coalesce(_c(col), F.lit(0))


def safe_divide(num: Column | str, den: Column | str) -> Column:
    """Division that yields NULL on a zero or null divisor."""
    return F.try_divide(_c(num), F.nullif(_c(den), F.lit(0)))


def is_on_time(delay_minutes: Column | str) -> Column:
    return _c(delay_minutes) <= ON_TIME_LIMIT_MINUTES


def weight_in_range(weight: Column | str) -> Column:
    """Open range ``0 < w < 10000``; a null weight is rejected."""
    w = _c(weight)
    return (w > MIN_PACKAGE_WEIGHT_EXCLUSIVE) & (w < MAX_PACKAGE_WEIGHT_EXCLUSIVE)


def deliveries_per_hour(deliveries_in_trip: Column | str, trip_hours: Column | str) -> Column:
    return round_even(_c(deliveries_in_trip) / _c(trip_hours), 2)


def fuel_efficiency(distance_km: Column | str, fuel_liters: Column | str) -> Column:
    return round_even(_c(distance_km) / _c(fuel_liters), 2)


def cost_per_delivery(
    fuel_liters: Column | str, toll_cost: Column | str, deliveries_in_trip: Column | str
) -> Column:
    """(litres x fuel price + toll) / deliveries of the trip; missing litres cost 0."""
    spend = fill_zero(fuel_liters) * FUEL_PRICE_PER_LITER + _c(toll_cost)
    return round_even(spend / _c(deliveries_in_trip), 2)


def revenue_per_delivery(weight_kg: Column | str) -> Column:
    return round_even(F.lit(BASE_REVENUE) + _c(weight_kg) * REVENUE_PER_KG, 2)


def has_signature(signature: Column | str) -> Column:
    """Signed when the text is present and not empty (any other text counts)."""
    s = _c(signature)
    return s.isNotNull() & (s != "")


def full_name(first: Column | str, last: Column | str) -> Column:
    """``trim(first) || ' ' || trim(last)``; null when either part is null."""
    return F.concat(F.trim(_c(first)), F.lit(" "), F.trim(_c(last)))


def empty_text(col: Column | str) -> Column:
    """True when the text is null or ''."""
    return F.coalesce(_c(col), F.lit("")) == ""


# Fixed value: connective of the maintenance description text.
MAINTENANCE_DESCRIPTION_JOIN = " programado para "


def address_text(street: Column | str, city: Column | str) -> Column:
    """Delivery address ``<street>, <city>``."""
    return F.concat(_c(street), F.lit(", "), _c(city))


def maintenance_description(maintenance_type: Column | str, maintenance_date: Column | str) -> Column:
    """``<type> programado para <yyyy-MM-dd>``."""
    return F.concat(
        _c(maintenance_type), F.lit(MAINTENANCE_DESCRIPTION_JOIN), F.date_format(_c(maintenance_date), "yyyy-MM-dd")
    )


def toll_by_band(distance_km: Column | str) -> Column:
    """Toll: whole 100 km bands x 15000."""
    return (F.floor(_c(distance_km) / TOLL_BAND_KM) * TOLL_PER_BAND).cast("decimal(10,2)")


def zero_pad(number: Column | str, width: int) -> Column:
    """Left-pad digits with zeros to ``width``; longer numbers stay whole."""
    s = _c(number).cast("string")
    return F.when(F.length(s) >= width, s).otherwise(F.lpad(s, width, "0"))


def format_code(prefix: str, number: Column | str, width: int) -> Column:
    """Zero-padded business key such as ``EMP0001`` or ``R001``."""
    return F.concat(F.lit(prefix), zero_pad(number, width))


def tracking_code(year: Column | str | int, seq: Column | str, width: int = 8) -> Column:
    """``FL<year><seq padded to 8>`` tracking numbers."""
    y = F.lit(year) if isinstance(year, int) else _c(year)
    return F.concat(F.lit("FL"), y.cast("string"), zero_pad(seq, width))


def trip_status(arrival: Column | str, now: Column) -> Column:
    """Completed when the arrival lies before ``now``, else in progress."""
    return F.when(_c(arrival) < now, "completed").otherwise("in_progress")
