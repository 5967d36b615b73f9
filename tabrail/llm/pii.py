"""Personal data: patterns propose spans, checksums confirm them, context scores them.

Kinds, in output order: email, ip, card (Luhn), phone, iban (mod 97), ssn
(kept only near a context word). Positions are code points, end exclusive.
DataFrame functions only.

The published patterns contain repeated groups, which a backtracking engine
runs by recursion; on very long texts that overflows the stack. Separators
that may stand inside a match are therefore marked first (one character for
one), and the match itself is a plain run of a character class. The spans are
the same (see tests/llm/test_pii.py).

Rows: a null or empty text has no spans; null ids and repeated rows are kept
as they are; an empty table gives an empty result; other columns of the input
are not read. Texts of any length, and with any number of spans, are scanned
whole: spans are placed in groups, so the work grows with the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabrail.llm.common import table

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = BASE_KINDS + ("iban", "ssn")
#: Marks a separator inside a match; the same character in a text is neutralised first.
MARK, NEUTRAL = "\u0001", "\u0002"
#: Score of a confirmed span, before its context.
PRIOR = {"email": 0.8, "ip": 0.5, "card": 0.7, "phone": 0.5, "iban": 0.8, "ssn": 0.3}
CONTEXT = {
    "email": r"\b(e-?mail|mail|contact|write|reply)\b",
    "ip": r"\b(ip|host|server|address|login)\b",
    "card": r"\b(card|visa|mastercard|amex|credit|debit|payment)\b",
    "phone": r"\b(phone|tel|call|mobile|cell|fax|whatsapp)\b",
    "iban": r"\b(iban|account|bank|konto|transfer)\b",
    "ssn": r"\b(ssn|social|security)\b",
}
BONUS, MALUS, WINDOW, KEEP = 0.2, 0.2, 40, 0.5
#: Words that speak against personal data near a number.
AGAINST = r"\b(version|isbn|serial|order|invoice|ticket|build|example)\b"

_LOCAL = r"[A-Za-z0-9._%+\x01-]"
_PATTERN = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++\x01[A-Za-z0-9\x01-]++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # Runs of digits with single separators between them, where the run has 13 to 19 digits.
    "card": r"(?<![0-9\x01])(?=(?:\x01?[0-9]){13,19}+(?![0-9\x01]))[0-9\x01]++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
#: A cheap test that every text with a match passes.
_GATE = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){12}", "phone": r"\+[0-9]",
         "iban": r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11}", "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}"}
_NONE = "array<struct<m:string,start:bigint,near:string>>"
#: Matches, and spans, that are added up or put together in one go: the work
#: on a text's k matches is then k * GO and (k / GO) ** 2 small steps, not k ** 2.
GO = 512
#: Matches on each side that hold the context window (no match is shorter than four).
ASIDE = 11


def _goes(n: Column) -> Column:
    """Numbers 0, 1, ... of the groups of ``GO`` among n > 0 things."""
    return F.sequence(F.lit(0), F.floor((n - 1) / GO).cast("int"))


def _starts(parts: Column, found: Column, sums: Column) -> Column:
    """Code-point starts of the matches; ``sums`` are the lengths of groups of ``GO`` parts with their matches."""
    def group(k):
        before = F.aggregate(F.slice(sums, F.lit(1), k), F.lit(0).cast("long"), lambda a, x: a + x)
        pairs = F.zip_with(F.slice(parts, k * GO + 1, F.lit(GO)), F.slice(found, k * GO + 1, F.lit(GO)), lambda p, m: F.struct(p.alias("p"), m.alias("m")))
        zero = F.struct(before.alias("at"), F.array().cast("array<bigint>").alias("out"))
        return F.aggregate(F.filter(pairs, lambda x: x["m"].isNotNull()), zero, lambda a, x: F.struct(
            (a["at"] + F.length(x["p"]) + F.length(x["m"])).alias("at"),
            F.concat(a["out"], F.array(a["at"] + F.length(x["p"]))).alias("out")))["out"]

    return F.flatten(F.transform(_goes(F.size(found)), group))


def _group_sums(parts: Column, found: Column) -> Column:
    def length(k):
        total = lambda c: F.aggregate(F.slice(c, k * GO + 1, F.lit(GO)), F.lit(0).cast("long"), lambda a, x: a + F.length(x))
        return total(parts) + total(found)

    return F.transform(_goes(F.size(found)), length)


def _near(parts: Column, found: Column, i: Column) -> Column:
    """The ``WINDOW`` code points on both sides of match i (from 0), put
    together from the parts around it (by place: a slice would walk the array)."""
    def at(c, k):
        return F.coalesce(F.get(c, i + k), F.lit(""))

    before = [x for k in range(ASIDE, 0, -1) for x in (F.right(at(parts, -k), F.lit(WINDOW)), at(found, -k))]
    after = [x for k in range(1, ASIDE + 1) for x in (at(found, k), F.left(at(parts, k + 1), F.lit(WINDOW)))]
    return F.concat(F.right(F.concat(*before, F.right(at(parts, 0), F.lit(WINDOW))), F.lit(WINDOW)), F.lit(" "),
                    F.left(F.concat(F.left(at(parts, 1), F.lit(WINDOW)), *after), F.lit(WINDOW)))


def _matches(parts: str, found: str, starts: str) -> Column:
    """[(match, start, context)] of the leftmost non-overlapping matches."""
    def one(m, i):
        return F.struct(m.alias("m"), F.get(F.col(starts), i).alias("start"), _near(F.col(parts), F.col(found), i).alias("near"))

    return F.transform(F.col(found), one)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    n = F.length(digits)
    total = F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda a, i: a + F.when(
        (n - i) % 2 == 0, F.substring(digits, i, F.lit(1)).cast("int")).otherwise(
        F.element_at(F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), F.substring(digits, i, F.lit(1)).cast("int") + 1)))
    return total % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether an IBAN's rearranged number leaves 1 on division by 97."""
    moved = F.concat(F.substring(iban, F.lit(5), F.length(iban)), F.substring(iban, F.lit(1), F.lit(4)))
    left = F.aggregate(F.sequence(F.lit(1), F.length(moved)), F.lit(0), lambda a, i: F.when(
        F.substring(moved, i, F.lit(1)).rlike("[0-9]"), (a * 10 + F.substring(moved, i, F.lit(1)).try_cast("int")) % 97).otherwise(
        (a * 100 + F.ascii(F.substring(moved, i, F.lit(1))) - 55) % 97))
    return left == 1


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        small = lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.coalesce(F.substring(F.ltrim(p, F.lit("0")), F.lit(1), F.lit(3)).try_cast("int"), F.lit(0)) <= 255)
        return F.forall(F.split(m, r"\."), small)
    if kind == "card":
        return luhn(_digits(m))
    if kind == "phone":
        return F.length(_digits(m)).between(9, 15)
    if kind == "iban":
        return mod97(m)
    return F.lit(True)


def _score(kind: str, near: Column) -> Column:
    near = F.lower(near)
    s = F.lit(PRIOR[kind]) + F.when(near.rlike(CONTEXT[kind]), F.lit(BONUS)).otherwise(F.lit(0.0)) - F.when(near.rlike(AGAINST), F.lit(MALUS)).otherwise(F.lit(0.0))
    return F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), s)), 2)


def _confirmed(kind: str) -> Column:
    """The candidates of a kind that pass its validator, as (kind, start, end, score)."""
    def span(x):
        end = x["start"] + F.length(x["m"])
        return F.struct(F.lit(kind).alias("kind"), x["start"].alias("start"), end.alias("end"), _score(kind, x["near"]).alias("score"))

    spans = F.transform(F.filter(f"m_{kind}", lambda x: _valid(kind, x["m"])), span)
    return spans if kind in BASE_KINDS else F.filter(spans, lambda x: x["score"] >= KEEP)


def find_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, spans): spans is an array of (kind, start, end, score).

    All base spans stay whatever their score; iban and ssn need ``KEEP``.
    """
    plain = F.translate(F.col("text"), MARK, NEUTRAL)
    seen = {
        "email": F.regexp_replace(plain, r"(?<=[A-Za-z0-9-])\.(?=[A-Za-z0-9-])", MARK),
        "card": F.regexp_replace(plain, r"(?<=[0-9])[\x20-](?=[0-9])", MARK),
    }
    df = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # Every step is a column of its own, so that none is worked out twice. One
    # that a lambda alone reads would be moved into it and worked out for every
    # element, so each is also read outside (its size).
    steps: list[dict[str, Column]] = [{}, {}, {}, {}, {}]
    for kind in KINDS:
        gate = F.contains("text", F.lit("@")) if kind == "email" else F.col("text").rlike(_GATE[kind])
        source, f, p = seen.get(kind, F.col("text")), f"f_{kind}", f"p_{kind}"
        some = F.size(f) > 0
        steps[0][f] = F.when(gate, F.regexp_extract_all(source, F.lit(_PATTERN[kind]), F.lit(0))).otherwise(F.array().cast("array<string>"))
        steps[1][p] = F.when(some, F.split(source, _PATTERN[kind], -1))
        steps[2][f"l_{kind}"] = F.when(some, _group_sums(F.col(p), F.col(f)))
        steps[3][f"s_{kind}"] = F.when(some & (F.size(f"l_{kind}") > 0), _starts(F.col(p), F.col(f), F.col(f"l_{kind}")))
        steps[4][f"m_{kind}"] = F.when(some & (F.size(f"s_{kind}") > 0), _matches(p, f, f"s_{kind}")).otherwise(F.array().cast(_NONE))
    for step in steps:
        df = df.withColumns(step)
    df = df.select("doc_id", "text", *[_confirmed(kind).alias(f"m_{kind}") for kind in KINDS])
    return df.select("doc_id", "text", *[F.col(f"m_{k}").alias(k) for k in KINDS])


def redact(spans: DataFrame, out: str = "new_text") -> DataFrame:
    """Add ``out``: the text with every span (overlapping ones as one) replaced by its kind in brackets."""
    t = F.col("text")
    ordered = F.array_sort(F.transform(F.concat(*[F.col(k) for k in KINDS]), lambda x: F.struct(x["start"].alias("start"), (-x["end"]).alias("order"), x["end"].alias("end"), x["kind"].alias("kind"))))
    df = spans.withColumn("__all", ordered)
    some = F.size("__all") > 0
    groups = F.transform(_goes(F.size("__all")), lambda k: F.slice("__all", k * GO + 1, F.lit(GO)))
    df = df.withColumn("__groups", F.when(some, groups))
    df = df.withColumn("__ends", F.transform("__groups", lambda g: F.array_max(F.transform(g, lambda x: x["end"]))))

    def group(g, k):
        # The text from the last end before the group to the last end in it.
        first = F.coalesce(F.array_max(F.slice("__ends", F.lit(1), k)), F.lit(0).cast("long"))
        last = F.array_max(F.slice("__ends", F.lit(1), k + 1))
        own = F.substring(t, (first + 1).cast("int"), (last - first).cast("int"))
        zero = F.struct(first.alias("at"), F.lit("").alias("out"))
        state = F.struct(first.alias("first"), own.alias("own"))
        return F.element_at(F.transform(F.array(state), lambda s: F.aggregate(g, zero, lambda a, x: F.struct(
            F.greatest(a["at"], x["end"]).alias("at"),
            F.when(x["start"] < a["at"], a["out"]).otherwise(F.concat(
                a["out"], F.substring(s["own"], (a["at"] - s["first"] + 1).cast("int"), (x["start"] - a["at"]).cast("int")), F.lit("["), F.upper(x["kind"]), F.lit("]"))).alias("out")),
            lambda a: a["out"])), 1)

    rest = F.substring(t, (F.array_max("__ends") + 1).cast("int"), F.length(t))
    whole = F.concat(F.array_join(F.transform("__groups", group), ""), rest)
    return df.withColumn(out, F.when(F.size("__all") > 0, whole).otherwise(t)).drop("__all", "__groups", "__ends")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_spans(table(spark, sf_dir, "documents"))
    label = lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))
    joined = lambda kinds: F.concat_ws(",", F.transform(F.concat(*[F.col(k) for k in kinds]), label))
    return found.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(joined(BASE_KINDS), 256).alias("base_sha256"), joined(KINDS).alias("spans"),
        F.round(F.coalesce(F.array_max(F.transform(F.concat(*[F.col(k) for k in KINDS]), lambda x: x["score"])), F.lit(0.0)), 2).alias("top_score"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every span becomes its kind in brackets; n_chars follows."""
    cols = docs.columns
    # All columns travel as one struct, so names of the input cannot clash with ours.
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("doc_id"), F.col("text"))
    done = redact(find_spans(packed))
    text = F.when(F.col("doc_id.text").isNull(), F.lit(None).cast("string")).otherwise(F.col("new_text"))
    return done.select("doc_id", text.alias("new_text")).select(*[
        F.col("new_text").alias(c) if c == "text" else
        F.length("new_text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(f"doc_id.`{c}`").alias(c) for c in cols])
