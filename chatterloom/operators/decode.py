"""JSON payloads -> typed events."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatterloom.functions.casts import TOLERANT
from chatterloom.schemas import ENRICHMENT, RAW_EVENT, ddl, struct_type

CORRUPT = "_corrupt"


def parse_once(payload: Column, schema: str, options: Mapping[str, str] | None = None) -> Column:
    """``from_json`` as a generator of exactly one row.

    A filter on parsed fields stays above a generator. It would otherwise move
    below the projection and parse every message once per field it names.
    """
    return F.explode(F.array(F.from_json(payload, schema, dict(options or {}))))


def decode(
    log: DataFrame,
    layout: Mapping[str, str] = RAW_EVENT,
    fields: Iterable[str] | None = None,
    *,
    keep: Iterable[str] = (),
) -> DataFrame:
    """The payload as struct ``data`` that holds just ``fields`` of the layout.

    A field that does not fit its type is null. Naming few fields keeps the
    JSON parser from building the rest. Columns of the log in ``keep`` stay.
    """
    return log.select(*keep, parse_once(F.col("payload"), ddl(layout, fields)).alias("data"))


# What a message means by leaving these fields out, in SQL.
_DEFAULTS = {
    "has_media": "false",
    "media_urls": "cast(array() as array<string>)",
    "is_crosspost": "false",
}


def _wire_layout(layout: Mapping[str, str]) -> dict[str, str]:
    """The layout with every tolerant scalar taken from the message as text."""
    return {n: "string" if t in TOLERANT else t for n, t in layout.items()}


def _typed(source: Column, layout: Mapping[str, str]) -> dict[str, Column]:
    return {n: TOLERANT[t](source[n]) if t in TOLERANT else source[n] for n, t in layout.items()}


def _unusable(source: Column, typed: Column, layout: Mapping[str, str], prefix: str = "") -> list[Column]:
    """Names of the fields whose text is there but does not fit the type."""
    return [
        F.when(source[n].isNotNull() & typed[n].isNull(), F.lit(prefix + n))
        for n, t in layout.items()
        if t in TOLERANT
    ]


def decode_tolerant(
    log: DataFrame, layout: Mapping[str, str] = RAW_EVENT, *, keep: Iterable[str] = ()
) -> DataFrame:
    """The payload as top-level event columns, accepting ``"5"`` for 5; columns in ``keep`` stay.

    Adds ``payload`` (for quarantine), ``_corrupt`` (the payload if it is no
    JSON object or has a field of the wrong shape) and ``_miscast``, the names
    of the fields whose value was present but unusable.
    """
    enriched = "enrichment" in layout
    scalars = {n: t for n, t in layout.items() if n != "enrichment"}
    wire = _wire_layout(scalars)
    if enriched:
        wire["enrichment"] = struct_type(_wire_layout(ENRICHMENT))
    schema, options = f"{ddl(wire)}, {CORRUPT} string", {"columnNameOfCorruptRecord": CORRUPT}
    keep = list(keep)
    wire_column = parse_once(F.col("payload"), schema, options).alias("wire")
    parsed = log.select("payload", *keep, wire_column)

    source, inner = F.col("wire"), F.col("wire.enrichment")
    columns = _typed(source, scalars)
    if enriched:
        fields = [value.alias(n) for n, value in _typed(inner, ENRICHMENT).items()]
        columns["enrichment"] = F.when(inner.isNotNull(), F.struct(*fields))
    # A column of its own, so that a value is cast once for itself and for the check of it.
    typed = F.struct(*[value.alias(n) for n, value in columns.items()]).alias("typed")
    parsed, typed = parsed.select("payload", *keep, "wire", typed), F.col("typed")
    unusable = _unusable(source, typed, scalars)
    if enriched:
        unusable += _unusable(inner, typed["enrichment"], ENRICHMENT, "enrichment.")
    # A payload without any usable column comes back as a null struct.
    corrupt = F.when(source.isNull(), F.col("payload")).otherwise(source[CORRUPT])
    return parsed.select(
        "payload",
        *keep,
        corrupt.alias(CORRUPT),
        F.array_compact(F.array(*unusable)).alias("_miscast"),
        *[
            (F.coalesce(typed[n], F.expr(_DEFAULTS[n])) if n in _DEFAULTS else typed[n]).alias(n) for n in columns
        ],
    )
