"""Scalar Column expressions (SURVEY X*). All JVM-side built-ins, no UDFs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..params import (BANNER_MAP, BLANK_BANNER, DEFAULT_BANNER, DEFAULT_MIME, MIME_MAP,
                      SENTINEL_DATE)

MONEY = "decimal(18,2)"
_DAY_MICROS = 86_400_000_000


def money(c: Column) -> Column:
    """Money is summed as DECIMAL(18,2) so sums do not depend on order."""
    return c.cast(MONEY)


def out_money(c: Column) -> Column:
    """Money at the output edge is DOUBLE."""
    return c.cast("double")


def zero_money() -> Column:
    return F.lit(0).cast(MONEY)


def ts_text(c: Column) -> Column:
    """Timestamp text as the curated tables store it (X32 without zone)."""
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def nullif_blank(c: Column) -> Column:
    """'' -> NULL."""
    return F.when(c != "", c)


def default_label(c: Column, label: str) -> Column:
    """NULL and '' both take the default label."""
    return F.coalesce(nullif_blank(c), F.lit(label))


def _literal_map(mapping: dict[str, str]) -> Column:
    items = []
    for k, v in mapping.items():
        items += [F.lit(k), F.lit(v)]
    return F.create_map(*items)


def banner(store_type: Column) -> Column:
    """Blank -> Unknown; else map upper(trim(code)) with a default."""
    code = F.upper(F.trim(store_type))
    return (
        F.when(store_type.isNull() | (store_type == ""), F.lit(BLANK_BANNER))
        .otherwise(F.coalesce(_literal_map(BANNER_MAP)[code], F.lit(DEFAULT_BANNER)))
    )


def mime_type(name: Column) -> Column:
    """Extension after the last '.', lower-cased; no dot -> default."""
    ext = F.when(name.contains("."), F.lower(F.substring_index(name, ".", -1))).otherwise(F.lit(""))
    return F.coalesce(_literal_map(MIME_MAP)[ext], F.lit(DEFAULT_MIME))


def doc_kind(mime: Column) -> Column:
    """Pdf / image / other from a MIME type."""
    return F.when(mime.contains("pdf"), "pdf").when(mime.contains("image"), "image").otherwise("other")


def aging_days(ts: Column, as_of: str) -> Column:
    """Whole days from ``ts`` to ``as_of``, truncated toward zero."""
    diff = F.unix_micros(F.lit(as_of).cast("timestamp")) - F.unix_micros(ts.try_cast("timestamp"))
    return (diff / F.lit(_DAY_MICROS)).cast("int")


def aging_band(days: Column) -> Column:
    """X19; no band without an age."""
    return F.when(days >= 60, "60+").when(days >= 30, "30-59").when(days.isNotNull(), "0-29")


def safe_pct(n: Column, d: Column) -> Column:
    """n/d*100, 0 when d is 0 or NULL."""
    return F.when(F.coalesce(d, F.lit(0)) != 0, n.cast("double") / d.cast("double") * 100).otherwise(F.lit(0.0))


def _dollars(v: Column, digits: int) -> Column:
    """``$`` then the signed number: $-2.00. Ties round on the binary value."""
    sign = F.when(v < 0, F.lit("-")).otherwise(F.lit(""))
    return F.concat(F.lit("$"), sign, F.format_number(F.abs(v), digits))


def currency_text(c: Column) -> Column:
    """$1,234.56; NULL -> $0.00; negatives as $-1,234.56."""
    return _dollars(F.coalesce(c.cast("double"), F.lit(0.0)), 2)


def short_currency(c: Column) -> Column:
    """$1.2M / $3K / $5."""
    v = F.coalesce(c.cast("double"), F.lit(0.0))
    return (F.when(F.abs(v) >= 1_000_000, F.concat(_dollars(v / 1_000_000, 1), F.lit("M")))
            .when(F.abs(v) >= 1_000, F.concat(_dollars(v / 1_000, 0), F.lit("K")))
            .otherwise(_dollars(v, 0)))


def date_prefix(c: Column) -> Column:
    """First 10 characters (the date part)."""
    return F.substring(c, 1, 10)


def minute_text(c: Column) -> Column:
    """First 16 characters with 'T' shown as a space."""
    return F.replace(F.substring(c, 1, 16), F.lit("T"), F.lit(" "))


def blank_sentinel(c: Column) -> Column:
    """The sentinel completion date is shown as blank."""
    return F.when(date_prefix(c) != SENTINEL_DATE, c)


def type_label(c: Column, program_token: str) -> Column:
    """Project type without the program prefix."""
    return F.replace(c, F.lit(program_token + " "), F.lit(""))


def type_label_first(c: Column, program_token: str) -> Column:
    """X16 as the static page shows it: only the first occurrence is removed."""
    prefix = F.lit(program_token + " ")
    at = F.instr(c, prefix)
    return F.when(at > 0, F.overlay(c, F.lit(""), at, F.length(prefix))).otherwise(c)


def entity_link(project_id: Column, base: str, page: str) -> Column:
    """Page of a project in the document system; ``page`` is the path up to the id."""
    return F.concat(F.lit(f"{base}{page}"), project_id)


def type_category(c: Column, words: tuple[str, ...]) -> Column:
    """First word of ``words`` contained in the type, else 'OTHER'."""
    out = F.lit("OTHER")
    for w in reversed(words):
        out = F.when(F.coalesce(c, F.lit("")).contains(w), F.lit(w)).otherwise(out)
    return out


def location_text(city: Column, state: Column) -> Column:
    """X37: 'city, state' with blanks for NULLs."""
    return F.concat(F.coalesce(city, F.lit("")), F.lit(", "), F.coalesce(state, F.lit("")))


def po_key(proj_def: Column) -> Column:
    """Project definition -> PO-side key (strip '-', append 00000)."""
    return F.concat(F.replace(proj_def, F.lit("-"), F.lit("")), F.lit("00000"))
