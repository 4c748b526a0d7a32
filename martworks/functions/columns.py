"""Column helpers. Every helper returns a built-in Column expression, so it stays
inside whole-stage code generation; there is no Python UDF in the package."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# State codes by macro-region.
REGION_STATES = {
    "Norte": ["AC", "AP", "AM", "PA", "RO", "RR", "TO"],
    "Nordeste": ["AL", "BA", "CE", "MA", "PB", "PE", "PI", "RN", "SE"],
    "Centro-Oeste": ["DF", "GO", "MT", "MS"],
    "Sudeste": ["ES", "MG", "RJ", "SP"],
    "Sul": ["PR", "RS", "SC"],
}
UNKNOWN_REGION = "Unknown"

# Bounding box for plausible coordinates.
LATITUDE_RANGE = (-33.75, 5.27)
LONGITUDE_RANGE = (-73.99, -34.79)

# Product weight bands in grams (upper bound exclusive).
WEIGHT_EDGES = (500, 2000, 10000)
WEIGHT_LABELS = ("light", "medium", "heavy", "oversized")
UNKNOWN = "unknown"

# Stands in for NULL inside a surrogate key, so that NULL and '' hash differently.
NULL_KEY_TOKEN = "_null_"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def zip5(c: Column | str) -> Column:
    """Postcode prefix as exactly five characters, zero-padded on the left."""
    return F.lpad(F.trim(_col(c)), 5, "0")


def title_case(c: Column | str) -> Column:
    return F.initcap(F.trim(_col(c)))


def text_or_null(c: Column | str) -> Column:
    """Trimmed text; blank becomes NULL."""
    return F.nullif(F.trim(_col(c)), F.lit(""))


def macro_region(state: Column | str) -> Column:
    code = F.upper(F.trim(_col(state)))
    region = F.lit(UNKNOWN_REGION)
    for name, states in REGION_STATES.items():
        region = F.when(code.isin(states), F.lit(name)).otherwise(region)
    return region


def in_bounds(lat: Column | str, lng: Column | str) -> Column:
    return _col(lat).between(*LATITUDE_RANGE) & _col(lng).between(*LONGITUDE_RANGE)


def numeric(c: Column | str, scale: int) -> Column:
    """Exact decimal rounded half-up at ``scale``: going through a decimal first
    avoids the binary-fraction ties that rounding a double directly runs into."""
    return F.round(_col(c).cast("decimal(28,6)"), scale)


def money(c: Column | str) -> Column:
    return numeric(c, 2).cast("decimal(18,2)")


def rate(num: Column | str, den: Column | str, scale: int | None = 4) -> Column:
    """``num / den`` in double precision, NULL when there is no denominator."""
    n, d = _col(num).cast("double"), _col(den).cast("double")
    ratio = F.when(d != 0, n / d)
    return ratio if scale is None else F.round(ratio, scale)


def surrogate_key(*cols: Column | str) -> Column:
    parts = [F.coalesce(_col(c).cast("string"), F.lit(NULL_KEY_TOKEN)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def days_between(start: Column | str, end: Column | str) -> Column:
    """Number of midnights crossed from ``start`` to ``end``."""
    return F.datediff(_col(end), _col(start)).cast("bigint")


def hours_between(start: Column | str, end: Column | str) -> Column:
    """Number of full-hour boundaries crossed (10:59 to 11:01 is one).

    Built from the day difference and the two hours of day, so it does not depend
    on the session time zone when the inputs are zone-less timestamps."""
    a, b = _col(start), _col(end)
    return (F.datediff(b, a) * 24 + F.hour(b) - F.hour(a)).cast("bigint")


def bucket(c: Column | str, edges, labels, null_label: str) -> Column:
    """Label by half-open bands: below ``edges[0]`` gives ``labels[0]`` and so on."""
    value = _col(c)
    banded = F.when(value.isNull(), F.lit(null_label))
    for edge, label in zip(edges, labels):
        banded = banded.when(value < edge, F.lit(label))
    return banded.otherwise(F.lit(labels[len(edges)]))


def weight_class(grams: Column | str) -> Column:
    return bucket(grams, WEIGHT_EDGES, WEIGHT_LABELS, UNKNOWN)


def review_sentiment(score: Column | str) -> Column:
    s = _col(score)
    return (
        F.when(s >= 4, "promoter").when(s == 3, "passive").when(s <= 2, "detractor")
    )


def delivery_status(
    status: Column, approved: Column, shipped: Column, delivered: Column, late: Column
) -> Column:
    """First matching state wins; ``late`` is NULL until the order is delivered."""
    return (
        F.when(status == "canceled", "canceled")
        .when(late, "delivered_late")
        .when(delivered.isNotNull(), "delivered_on_time")
        .when(shipped.isNotNull(), "in_transit")
        .when(approved.isNotNull(), "approved")
        .otherwise("pending")
    )
