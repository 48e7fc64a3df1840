"""JSON messages: encode rows, decode bytes, and tell good messages from bad ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstream.entities import Entity
from tillstream.functions.ids import canonical_uuid
from tillstream.functions.isotime import iso_text

REASON = "reason"
# What the full contract has to know of a message: its parsed text, and the text's bytes.
DOCUMENT, SOUND = "_document", "_sound"


def json_message(frame: DataFrame) -> Column:
    """One JSON object per row: null fields are kept and no microsecond is lost."""
    cells = [
        iso_text(F.col(f.name)).alias(f.name)
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))
        else F.col(f.name)
        for f in frame.schema.fields
    ]
    return F.to_json(F.struct(*cells), {"ignoreNullFields": "false"})


def message_text(value: Column) -> Column:
    return value.cast("string")


def parse_fields(frame: DataFrame, text: Column, ddl: str, *keep: str) -> DataFrame:
    """Columns ``keep`` plus the fields of the JSON object in ``text``.

    The struct is unfolded with ``inline``, not ``select("data.*")``. A filter on
    a parsed field stays above a generator, whereas it would be pushed below a
    plain projection together with a second copy of the parse.
    """
    return frame.select(*keep, F.inline(F.array(F.from_json(text, ddl))))


def decode(messages: DataFrame, entity: Entity, *keep: str) -> DataFrame:
    """Message bytes to the fields of ``entity``; unreadable text gives null fields.

    Of several objects in one message the first is read, text after it is passed
    over, and bytes that are no UTF-8 become U+FFFD; the full contract refuses these.
    """
    return parse_fields(messages, message_text(F.col("value")), entity.message, *keep)


def as_sent(name: str) -> str:
    """Where a UUID column is kept as it came, next to its canonical form."""
    return f"_{name}"


def lenient_reason(entity: Entity) -> Column:
    """Why a record cannot be stored by key, or null when it can.

    A field of the wrong type is only null. A reference may be null, but it must
    be a UUID when it is there; the key must be there.
    """
    reason = F.when(F.col(as_sent(entity.key)).isNull(), F.lit(f"missing {entity.key}"))
    for name in entity.uuids:
        bad = F.col(as_sent(name)).isNotNull() & F.col(name).isNull()
        reason = reason.when(bad, F.lit(f"invalid {name}"))
    return reason


def _seal(text: Column) -> Column:
    return F.xxhash64(text).cast("string")


def with_documents(messages: DataFrame, text: Column) -> DataFrame:
    """Messages with their text parsed, once, into a variant.

    The parser stops at the end of the first document, so the text is put into an
    array in front of its own hash: only if it is one whole document is the hash
    second. The columns above a generator are never computed anew.
    """
    # Of a field sent twice the last one counts, as for the lenient parse.
    messages.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    sealed = F.concat(F.lit("["), text, F.lit(',"'), _seal(text), F.lit('"]'))
    facts = F.struct(
        F.try_parse_json(sealed).alias(DOCUMENT), F.is_valid_utf8(text).alias(SOUND)
    )
    return messages.select("*", F.inline(F.array(facts)))


def once(frame: DataFrame, *columns: Column) -> DataFrame:
    """``frame`` with further columns that are computed once, however often columns above
    refer to them: what stands above a generator is never put together with it."""
    return frame.select("*", F.inline(F.array(F.struct(*columns))))


def fields_of(entity: Entity, text: Column) -> Column:
    """The fields of ``entity`` as variants; null when the text is not one JSON object."""
    document = F.col(DOCUMENT)
    whole = F.try_variant_get(document, "$[1]", "string") == _seal(text)
    wanted = ", ".join(f"`{name}` variant" for name in entity.columns)
    return F.when(whole, F.try_variant_get(document, "$[0]", f"struct<{wanted}>"))


def kinds_of(entity: Entity, fields: Column) -> Column:
    """The JSON type of each field, null where the field is missing."""
    kinds = [F.schema_of_variant(fields[name]).alias(name) for name in entity.columns]
    return F.when(fields.isNotNull(), F.struct(*kinds))


def record_of(entity: Entity, fields: Column, kinds: Column) -> Column:
    """Per field of ``entity`` a struct of its value and its JSON type; null when the
    text is not one JSON object. Values are those of the field's own type, so a number
    sent as text is none. ``fields`` and ``kinds`` should be columns, not expressions:
    each of them is looked at many times."""
    cells = []
    for field in entity.schema:
        cell, kind = fields[field.name], kinds[field.name]
        value = F.try_variant_get(cell, "$", field.dataType.simpleString())
        right = _right_kind(field.dataType, kind)
        cells.append(F.struct(F.when(right, value).alias("value"), kind.alias("kind")).alias(field.name))
    return F.when(fields.isNotNull(), F.struct(*cells))


def _right_kind(kind: T.DataType, sent: Column) -> Column:
    """Whether a JSON value of type ``sent`` may stand in a field of type ``kind``."""
    if isinstance(kind, T.StringType):
        return sent == "STRING"
    if isinstance(kind, T.BooleanType):
        return sent == "BOOLEAN"
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return sent.isin("STRING", "BIGINT")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        # Text may name a number that is none, or is endless: told apart below.
        return sent.isin("BIGINT", "DOUBLE", "STRING") | sent.startswith("DECIMAL")
    return sent == "BIGINT"


def strict_reason(entity: Entity, text: Column, record: Column, uuids) -> Column:
    """Why a message breaks the full contract, or null when it keeps it.

    The text must be valid UTF-8 and one JSON object with every expected field
    present (null is a value), every field must have its type, numbers must be
    finite, and every UUID column must hold one. ``record`` is that of
    :func:`record_of`; ``uuids`` finds the canonical form of a UUID column, null when
    invalid. Only a message without a record is looked at again, to say why.
    """
    reason = (
        F.when(~F.col(SOUND), F.lit("not UTF-8 text"))
        .when(
            record.isNull(),
            F.when(F.json_object_keys(text).isNull(), F.lit("not a JSON object")).otherwise(
                F.lit("not one JSON document")
            ),
        )
    )
    missing, wrong, endless = F.lit(False), F.lit(False), F.lit(False)
    for field in entity.schema:
        value, kind = record[field.name]["value"], record[field.name]["kind"]
        missing = missing | kind.isNull()
        wrong = wrong | (value.isNull() & (kind != "VOID"))
        if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
            # Not a number counts as greater than infinity.
            beyond = F.coalesce(F.abs(value) >= F.lit(float("inf")), F.lit(False))
            endless = endless | beyond
            wrong = wrong | ((kind == "STRING") & ~beyond)
    reason = (
        reason.when(missing, F.lit("missing field"))
        .when(wrong, F.lit("wrong type"))
        .when(endless, F.lit("number out of range"))
    )
    for name in entity.uuids:
        reason = reason.when(uuids(name).isNull(), F.lit(f"invalid {name}"))
    return reason


def canonical_keys(decoded: DataFrame, entity: Entity) -> DataFrame:
    """UUID columns in canonical form, so that one key has one spelling; null for
    what is no UUID. The text that was sent is kept aside."""
    kept = decoded.withColumnsRenamed({name: as_sent(name) for name in entity.uuids})
    return kept.withColumns({name: canonical_uuid(F.col(as_sent(name))) for name in entity.uuids})


def grade_lenient(messages: DataFrame, entity: Entity) -> DataFrame:
    """Messages with their fields and a ``reason``, null for a usable record."""
    decoded = canonical_keys(decode(messages, entity, "*"), entity)
    graded = decoded.withColumn(REASON, lenient_reason(entity))
    return graded.drop(*[as_sent(name) for name in entity.uuids])


def grade_strict(messages: DataFrame, entity: Entity) -> DataFrame:
    """As :func:`grade_lenient`, with the full contract."""
    text = message_text(F.col("value"))
    parsed = with_documents(messages, text)
    found = once(parsed, fields_of(entity, text).alias("_fields")).drop(DOCUMENT)
    typed = once(found, kinds_of(entity, F.col("_fields")).alias("_kinds"))
    record = record_of(entity, F.col("_fields"), F.col("_kinds"))
    read = once(typed, record.alias("_record")).drop("_fields", "_kinds")
    cells = {name: F.col("_record")[name]["value"] for name in entity.columns}
    cells |= {name: canonical_uuid(cells[name]) for name in entity.uuids}
    graded = read.withColumns(cells)
    reason = strict_reason(entity, text, F.col("_record"), F.col)
    return graded.withColumn(REASON, reason).drop("_record", SOUND)


def accepted(graded: DataFrame) -> DataFrame:
    return graded.filter(F.col(REASON).isNull())


def rejected(graded: DataFrame) -> DataFrame:
    return graded.filter(F.col(REASON).isNotNull())
