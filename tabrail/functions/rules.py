"""Scoring-request rules (D1-D3) and the response table (M5).

The reference reads 8 fields with ``float(data.get(name, 0))`` and answers
400 for unparsable text, 500 for JSON null (``float(None)`` raises a
TypeError only its general handler catches) and 400 when any field is 0.
The first failing field in feature order decides the status, as the
reference's field-by-field conversion does.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabrail.functions.columns import price_format

OK = 0
BAD_TEXT = 400
JSON_NULL = 500
NOT_OBJECT = 500
MISSING = 400

#: Internal code of an array or object in a numeric field; its status is 500.
NESTED = -500
#: Beginnings of texts that may be no JSON strings (the parser gives other kinds without leading space).
DOUBTFUL = ("true", "false", "[", "{")
#: A body that is form fields when nothing else says what it is.
FORM = r"^[^\s={}\[\]\"]+="

#: Texts that count as numbers: digits may be apart by single underscores;
#: a trailing type letter ("5d", "5f") is no number.
_DIGITS = "[0-9](?:_?[0-9])*"
NUMBER = (rf"(?i)^\s*[+-]?(?:(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:e[+-]?{_DIGITS})?"
          r"|inf(?:inity)?|nan)\s*$")


def _json_fields(body: Column, features: Sequence[str]) -> Column:
    """The body's fields as texts (numbers keep their literal text, JSON null
    stays null); null if the body is not exactly one JSON object.

    The body is read as the first element of an array whose second one holds
    its hash: text behind the object breaks the array or shifts the hash."""
    schema = T.ArrayType(T.StructType([T.StructField(c, T.StringType()) for c in features] + [T.StructField("_tr_z", T.LongType())]))
    sealed = F.concat(F.lit("["), body, F.lit(',{"_tr_z":'), F.xxhash64(body).cast("string"), F.lit("}]"))
    return F.from_json(sealed, schema)


def _unquoted(text: Column) -> Column:
    """Form text with + and %XX resolved; a broken % stays as it is."""
    return F.coalesce(F.try_url_decode(text), F.replace(text, F.lit("+"), F.lit(" ")))


def _form_fields(body: Column) -> Column:
    """name=value pairs of a form body as (name, value) structs, in order."""
    def pair(p: Column) -> Column:
        cut = F.instr(p, "=")
        name = F.when(cut > 0, F.substring(p, F.lit(1), cut - 1)).otherwise(p)
        value = F.when(cut > 0, F.substring(p, cut + 1, F.length(p))).otherwise(F.lit(""))
        return F.struct(_unquoted(name).alias("name"), _unquoted(value).alias("value"))

    return F.transform(F.filter(F.split(body, "&"), lambda p: p != ""), pair)


def request_parse(df: DataFrame, features: Sequence[str], body: str = "body",
                  keep: Sequence[str] = ("request_id",), content_type: str | None = None) -> DataFrame:
    """Request text -> 8 doubles (absent -> 0) + ``status`` + ``reason``.

    Per field: absent -> 0.0; JSON null, array or object -> 500; true -> 1.0,
    false -> 0.0; text that is not a number -> 400; else the number. A body
    that is not one JSON object (text behind it included) -> 500.

    ``content_type`` names the column with the request's type: JSON types are
    read as JSON, urlencoded forms as ``name=value`` pairs (the first of a
    name counts), others have no fields. Without it, or where it is null, a
    body that starts with ``name=`` is a form and any other one JSON.

    The steps are staged as columns, so that every body is parsed once; key
    lists and value kinds are looked up only for bodies that need them.
    """
    text = F.col("_tr_body")
    rows = df.select(*keep, F.col(body).alias("_tr_body"), *([F.lower(content_type).alias("_tr_type")] if content_type else []))
    guess = F.when(text.rlike(FORM), F.lit("form")).otherwise(F.lit("json"))
    if content_type:
        mime = F.trim(F.substring_index("_tr_type", ";", 1))
        guess = (F.when(mime.isNull(), guess).when((mime == "application/json") | (mime.startswith("application/") & mime.endswith("+json")), F.lit("json"))
                 .when(mime == "application/x-www-form-urlencoded", F.lit("form")).otherwise(F.lit("none")))
    rows = rows.select(*keep, "_tr_body", guess.alias("_tr_how"))
    how = F.col("_tr_how")
    rows = rows.select(*keep, "_tr_body", "_tr_how",
                       F.when(how == "json", _json_fields(text, features)).alias("_tr_sealed"),
                       F.when(how == "form", _form_fields(text)).alias("_tr_form"))
    sealed = F.col("_tr_sealed")
    whole = (F.size(sealed) == 2) & (F.get(sealed, F.lit(1))["_tr_z"] == F.xxhash64(text))
    rows = rows.select(*keep, "_tr_body", "_tr_how", "_tr_form", F.when(whole, F.get(sealed, F.lit(0))).alias("_tr_raw"))
    raw, form = F.col("_tr_raw"), F.col("_tr_form")
    # Where all fields are there and hold digits and points alone, their texts
    # are cast as they are; the rules below are for the others.
    every = reduce(lambda a, b: a & b, (raw[c].isNotNull() for c in features), F.lit(True))
    digits = F.length(F.translate(F.concat_ws("", *[raw[c] for c in features]), "0123456789.", "")) == 0
    rows = rows.select(*keep, "_tr_body", "_tr_how", "_tr_form", "_tr_raw", (raw.isNotNull() & every & digits).alias("_tr_plain"))
    plain = F.col("_tr_plain")
    # A null text is an absent field or a JSON null: the keys tell. As text,
    # true and "true" are alike, as are [] and "[]": the kinds tell.
    some_null = any_of(raw[c].isNull() for c in features)
    doubtful = any_of(F.coalesce(any_of(raw[c].startswith(d) for d in DOUBTFUL), F.lit(False)) for c in features)
    rows = rows.select(*keep, "_tr_how", "_tr_form", "_tr_raw", "_tr_plain",
                       F.when(~plain & raw.isNotNull() & some_null, F.json_object_keys(text)).alias("_tr_keys"),
                       F.when(~plain & raw.isNotNull() & doubtful, F.try_parse_json(text)).alias("_tr_typed"))
    typed = F.col("_tr_typed")
    kinds = F.struct(*[F.schema_of_variant(F.try_variant_get(typed, f"$['{c}']", "variant")).alias(c) for c in features])

    def named(c: str) -> Column:
        return F.get(F.filter(form, lambda p: p["name"] == F.lit(c)), F.lit(0))["value"]

    rows = rows.select(*keep, "_tr_how", "_tr_raw", "_tr_plain", "_tr_keys", F.when(typed.isNotNull(), kinds).alias("_tr_kinds"), *[
        F.when(form.isNotNull(), named(c)).otherwise(raw[c]).alias(f"_tr_text{i}") for i, c in enumerate(features)])
    # The fields as an array: spelled out a column each, their code is over the
    # 8000 bytes of a method that the JVM compiles.
    fields = F.array(*[
        F.struct(F.col(f"_tr_text{i}").alias("text"), F.coalesce(F.col("_tr_kinds")[c], F.lit("")).alias("kind"),
                 ((F.col("_tr_how") == "json") & F.coalesce(F.array_contains("_tr_keys", F.lit(c)), F.lit(False))).alias("given"))
        for i, c in enumerate(features)])
    texts = F.array(*[F.col(f"_tr_text{i}") for i in range(len(features))])
    rows = rows.select(*keep, ((F.col("_tr_how") == "json") & raw.isNull()).alias("_tr_broken"), "_tr_plain",
                       F.when(plain, texts).alias("_tr_texts"), F.when(~plain, fields).alias("_tr_fields"))

    def value(f: Column) -> Column:
        own = f["text"]
        return (F.when(own.isNull(), F.when(~f["given"], F.lit(0.0)))
                .when(F.length(F.translate(own, "0123456789.", "")) == 0, own.try_cast("double"))
                .when(f["kind"] == "BOOLEAN", (own == "true").cast("double"))
                .when(own.rlike(NUMBER), F.regexp_replace(own, r"[_\s]", "").try_cast("double")))

    def code(f: Column, x: Column) -> Column:
        return (F.when(f["text"].isNull(), F.when(f["given"], F.lit(JSON_NULL)).otherwise(F.lit(OK)))
                .when(f["kind"].rlike("^(ARRAY|OBJECT)"), F.lit(NESTED))
                .when(x.isNull(), F.lit(BAD_TEXT)).otherwise(F.lit(OK)))

    cast = F.col("_tr_texts").try_cast("array<double>")
    rows = rows.select(*keep, "_tr_broken", "_tr_plain", "_tr_fields", F.when(plain, cast).otherwise(F.transform("_tr_fields", value)).alias("_tr_values"))
    bad = F.filter(F.zip_with("_tr_fields", "_tr_values", code), lambda n: n != OK)
    # Of plain texts only some are no numbers ("", "1.2.3").
    no_number = any_of(F.get("_tr_values", F.lit(i)).isNull() for i in range(len(features)))
    first_bad = F.when(plain, F.when(no_number, F.lit(BAD_TEXT)).otherwise(F.lit(OK))).otherwise(F.coalesce(F.get(bad, F.lit(0)), F.lit(OK)))
    staged = rows.select(*keep, "_tr_broken", "_tr_values", first_bad.alias("_tr_first"))
    staged = staged.select(*keep, "_tr_broken", *[F.get("_tr_values", F.lit(i)).alias(c) for i, c in enumerate(features)], "_tr_first")
    first = F.col("_tr_first")
    broken = F.col("_tr_broken")
    reason = (
        F.when(broken, F.lit("body is not a JSON object"))
        .when(first == NESTED, F.lit("nested value in a numeric field"))
        .when(first == JSON_NULL, F.lit("null value in a numeric field"))
        .when(first == BAD_TEXT, F.lit("invalid input: not a number"))
    )
    # A broken body has no fields.
    values = [F.when(~broken, F.col(c)).alias(c) for c in features]
    return staged.select(*keep, *values, F.when(broken, F.lit(NOT_OBJECT)).otherwise(F.abs(first)).alias("status"), reason.alias("reason"))


def any_of(conditions) -> Column:
    """Or over any number of conditions (``greatest`` needs two)."""
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def any_zero(features: Sequence[str]) -> Column:
    """Zero and missing are the same to the reference; NaN is not zero."""
    return any_of(F.coalesce(F.col(c) == F.lit(0.0), F.lit(False)) for c in features)


def request_validate(parsed: DataFrame, features: Sequence[str],
                     zero_is_missing: bool = True) -> DataFrame:
    """Of the parsed requests, reject with 400 when any feature is 0
    (the reference cannot tell 0 from an absent field). Rows already
    rejected by D1 keep their status. ``zero_is_missing=False`` accepts 0."""
    zero = any_zero(features) if zero_is_missing else F.lit(False)
    return parsed.withColumns({
        "status": F.when((F.col("status") == OK) & zero, F.lit(MISSING)).otherwise(F.col("status")),
        "reason": F.when((F.col("status") == OK) & zero, F.lit("all fields are required"))
                   .otherwise(F.col("reason")),
    }).withColumn("valid", F.col("status") == OK)


def request_form_rules(df: DataFrame, features: Sequence[str], non_negative: int = 6) -> DataFrame:
    """D3: the entry form's bounds: every field required, the first
    ``non_negative`` fields >= 0; latitude/longitude-like fields unbounded.
    Adds ``missing``, ``negative`` and ``violations`` counts."""
    missing = sum((F.col(c).isNull().cast("int") for c in features), F.lit(0))
    negative = sum((F.coalesce((F.col(c) < 0).cast("int"), F.lit(0)) for c in features[:non_negative]), F.lit(0))
    return df.withColumns({
        "missing": missing,
        "negative": negative,
        "violations": missing + negative,
    })


def score_requests(requests: DataFrame, model: PipelineModel, features: Sequence[str],
                   body: str = "body", request_id: str = "request_id",
                   zero_is_missing: bool = True, content_type: str | None = None) -> DataFrame:
    """M5: request table -> response table
    (request_id, success, status, predicted_price, predicted_price_usd,
    formatted_price, error).

    One pass, no union and no shuffle: rejected rows are scored on zeros
    and their outputs blanked. A NaN feature passes validation but fails
    in the model's assembler in the reference, so it answers 500 here.
    """
    checked = request_validate(request_parse(requests, features, body, (request_id,), content_type), features,
                               zero_is_missing)
    nan_any = any_of(F.coalesce(F.isnan(c), F.lit(False)) for c in features)
    status = F.when((F.col("status") == OK) & nan_any, F.lit(500)).otherwise(F.col("status"))
    reason = F.when((F.col("status") == OK) & nan_any, F.lit("prediction failed: NaN feature")) \
        .otherwise(F.col("reason"))
    ok = status == OK
    safe = checked.select(
        request_id,
        status.alias("_tr_status"),
        reason.alias("_tr_reason"),
        *[F.when(ok, F.col(c)).otherwise(F.lit(0.0)).alias(c) for c in features],
    )
    scored = model.transform(safe)
    good = F.col("_tr_status") == OK
    priced = price_format(F.when(good, F.col("prediction")))
    return scored.select(
        request_id,
        good.alias("success"),
        F.when(good, F.lit(200)).otherwise(F.col("_tr_status")).alias("status"),
        *priced,
        F.col("_tr_reason").alias("error"),
    )
