"""Personal data: base spans by rule, more by boosted trees over proposed spans.

Base spans are the leftmost non-overlapping matches of four patterns that pass their kind's check.
Generators with wider patterns propose further spans, which may overlap, and spans of a fifth kind, ``secret``: keys and
tokens. Gradient boosted trees score them by format and context. They learn, from ``TRAINING`` of all
documents' proposals, what evidence says of them: base spans, and proposals behind a word that names their kind that pass its check (sum of
digits, range of numbers, length), are personal data. All else counts as none: what fails the check, what cuts
a base span, and what no word speaks for. A threshold per kind is set on all other proposals, as far as they overlap no base span, as the least score from which ``PRECISION`` of them are personal data; a kind that never
reaches it adds nothing. Added spans overlap no base span.

Positions are code points, end exclusive. NULL and empty texts have no spans. Rows with equal id and
text are one document and get equal results; NULL ids are ids like any other. Without proposals of both kinds
of answer nothing is added. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import KEY, bound, keyed, matched, of_documents, sums_before, text_of
from millrace.operators.numbering import running_totals
from millrace.scratch import materialize

KINDS = ["email", "ip", "card", "phone"]
ALL_KINDS = [*KINDS, "secret"]
# The base patterns, written so that no position is scanned twice: a run can only begin where the
# character before it is not of the run, or where the last match ended, and gives nothing back.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# A character every match of a pattern holds; texts without it are not searched.
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
PROPOSALS = {
    "email": r"[^\x20\x09-\x0D@<>\"',;]{1,64}+@[^\x20\x09-\x0D@<>\"',;]{2,255}",
    "ip": r"(?<![0-9A-Za-z])[0-9]{1,3}(?:[.,:-][0-9]{1,3}){3}(?![0-9A-Za-z])",
    "card": r"(?<![0-9A-Za-z])[0-9]{3,6}(?:[\x20.-]?[0-9]{2,6}){2,5}(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z])\+?[0-9(](?:[\x20().-]{0,2}[0-9]){6,14}(?![0-9A-Za-z])",
    "secret": r"(?<![0-9A-Za-z_+/-])[0-9A-Za-z_+/-]{20,}+",
}
OCTET = "0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
CONTEXT = 24
STRETCH = 64
# The share of proposals, drawn by hash, that the trees learn from; thresholds are set on the others.
TRAINING = 0.6
PRECISION = 0.9
TREES, DEPTH = 10, 3
# Words that name a kind in front of a span (fixed values).
CUES = {
    "email": "mail|e-mail|contact|write to",
    "ip": "ip|host|server|address|addr",
    "card": "card|visa|mastercard|amex|credit|debit|payment",
    "phone": "phone|tel|telephone|call|fax|mobile|cell",
    "secret": "token|key|secret|password|passwd|bearer|credentials?",
}

SPAN = "array<struct<kind:string,start:int,end:int,value:string,before:string,after:string>>"


def matches(kind: str, pattern: str, needs: str | None = None) -> Column:
    """All matches of a pattern in ``text`` with their positions and what stands around them."""
    text, nothing = text_of(), F.array().cast(SPAN)
    parts = F.struct(
        F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found")
    )
    spans = bound(parts, lambda held: _placed(kind, held["gaps"], held["found"]))
    return F.when(F.contains(text, F.lit(needs)), spans).otherwise(nothing) if needs else spans


def _placed(kind: str, gaps: Column, found: Column) -> Column:
    """The matches ``found`` between ``gaps`` as spans."""
    before, after = F.slice(gaps, F.lit(1), F.size(found)), F.slice(gaps, F.lit(2), F.size(found))
    lengths = F.zip_with(before, found, lambda gap, value: F.char_length(gap) + F.char_length(value))
    each = F.arrays_zip(before.alias("gap"), found.alias("value"), after.alias("next"), sums_before(lengths).alias("at"))

    def span(x: Column) -> Column:
        start = x["at"] + F.char_length(x["gap"])
        return F.struct(
            F.lit(kind).alias("kind"), start.alias("start"), (start + F.char_length(x["value"])).alias("end"), x["value"].alias("value"),
            F.right(x["gap"], F.lit(CONTEXT)).alias("before"), F.left(x["next"], F.lit(CONTEXT)).alias("after"),
        )

    return F.transform(each, span).cast(SPAN)


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes: every second one from the right counts twice, by its cross sum."""
    each = F.transform(
        F.split(F.reverse(number), ""),
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
            2 * d.cast("int") - F.when(d.cast("int") > 4, 9).otherwise(0)
        ),
    )
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0


def passes(span: Column) -> Column:
    """The check of a base span's kind."""
    value, count = span["value"], F.char_length(digits(span["value"]))
    return (
        F.when(span["kind"] == "email", True)
        .when(span["kind"] == "ip", value.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$"))
        .when(span["kind"] == "card", F.when(count.between(12, 19), luhn(digits(value))).otherwise(False))
        .otherwise(count.between(9, 15))
    )


def proposed(docs: DataFrame) -> DataFrame:
    """Base spans and proposals of every document, without its text."""
    base = F.concat(*[matches(kind, BASE[kind], NEEDS[kind]) for kind in KINDS])
    wider = F.concat(*[matches(kind, PROPOSALS[kind], NEEDS[kind] if kind == "email" else None) for kind in ALL_KINDS])
    return keyed(docs).select(*KEY, F.filter(base, passes).alias("base"), wider.alias("wider"))


def cued(span: Column) -> Column:
    """Whether a word that names the span's kind stands right before it."""
    named = lambda kind: span["before"].rlike(rf"(?i)(?<![A-Za-z])({CUES[kind]})(?![A-Za-z])[^A-Za-z0-9]*$")
    return F.coalesce(reduce(lambda c, kind: c.when(span["kind"] == kind, named(kind)), ALL_KINDS, F), F.lit(False))


def valid(span: Column) -> Column:
    """The check of a proposal's kind, whatever signs stand between its parts."""
    value, count = span["value"], F.char_length(digits(span["value"]))
    return (
        F.when(span["kind"] == "email", value.rlike(r"^[^@]+@[^@]+\.\p{L}{2,}$"))
        .when(span["kind"] == "ip", value.rlike(rf"^{OCTET}([.,:-]){OCTET}\1{OCTET}\1{OCTET}$"))
        .when(span["kind"] == "card", F.when(count.between(12, 19), luhn(digits(value))).otherwise(False))
        .when(span["kind"] == "phone", count.between(7, 15))
        .otherwise(value.rlike("[0-9]") & value.rlike("[A-Za-z]"))
    )


def features(span: str) -> dict[str, Column]:
    """Format and context of a span, as numbers."""
    value = F.col(f"{span}.value")
    before, after = F.col(f"{span}.before"), F.col(f"{span}.after")
    share = lambda pattern: F.char_length(F.regexp_replace(value, pattern, "")) / F.char_length(value)
    yes = lambda condition: F.coalesce(condition, F.lit(False)).cast("double")
    return {
        "f_kind": reduce(lambda c, k: c.when(F.col(f"{span}.kind") == k[1], float(k[0])), enumerate(ALL_KINDS), F),
        "f_length": F.char_length(value).cast("double"),
        "f_digits": F.char_length(digits(value)).cast("double"),
        "f_letters": share("[^A-Za-z]"),
        "f_marks": share("[A-Za-z0-9]"),
        "f_dots": share("[^.]"),
        "f_hex": share("[^0-9A-Fa-f]"),
        "f_plus": yes(value.startswith("+")),
        "f_domain": yes(value.rlike(r"@[A-Za-z0-9-]+\.[A-Za-z0-9.-]*[A-Za-z]$")),
        "f_space_before": yes((before == "") | before.rlike(r"\s$")),
        "f_space_after": yes((after == "") | after.rlike(r"^[\s.,;:!?]")),
        "f_named": yes(cued(F.col(span))),
        "f_valid": yes(valid(F.col(span))),
        "f_digit_near": yes(before.rlike(r"[0-9]\W{0,2}$") | after.rlike(r"^\W{0,2}[0-9]")),
    }


def label(span: Column, near: Column, same: Column) -> Column:
    """1 for what evidence says is personal data, 0 for all else."""
    return (same | (~near & valid(span) & cued(span))).cast("double")


def compared(found: DataFrame) -> DataFrame:
    """A row per proposal: the columns of KEY, ``span``, whether it overlaps a base span (``_near``), and whether it is one (``_same``).

    Spans meet in stretches of ``STRETCH`` characters of their document, so that a text with very many of each is
    compared piece by piece and by many tasks."""
    stretch = lambda start, end: F.explode(F.sequence(F.floor(start / STRETCH), F.floor((end - 1) / STRETCH))).alias("_stretch")
    spans = found.select(*KEY, F.explode("wider").alias("span"))
    base = found.select(*KEY, F.explode("base").alias("_base"))
    base = base.select(*KEY, F.col("_base.start").alias("_start"), F.col("_base.end").alias("_end"))
    ours = spans.select(*KEY, F.col("span.kind").alias("_kind"), F.col("span.start").alias("_from"), F.col("span.end").alias("_to"))
    ours = ours.select("*", stretch(F.col("_from"), F.col("_to")))
    theirs = base.select("*", stretch(F.col("_start"), F.col("_end")))
    met = matched(ours, theirs, [*KEY, "_stretch"]).filter((F.col("_start") < F.col("_to")) & (F.col("_from") < F.col("_end")))
    same = (F.col("_start") == F.col("_from")) & (F.col("_end") == F.col("_to"))
    near = met.groupBy(*KEY, "_kind", "_from", "_to").agg(F.max(same).alias("_same"))
    names = {"_kind": "kind", "_from": "start", "_to": "end"}
    rows = spans.select("*", *[F.col(f"span.{field}").alias(name) for name, field in names.items()])
    marked = matched(rows, near, [*KEY, *names], "left")
    return marked.select(*KEY, "span", F.col("_same").isNotNull().alias("_near"), F.coalesce("_same", F.lit(False)).alias("_same"))


def scored(found: DataFrame) -> DataFrame | None:
    """Proposals that overlap no base span, with the score and the threshold of their kind; None where
    there is nothing to learn from."""
    rows = compared(found)
    rows = rows.withColumn("label", label(F.col("span"), F.col("_near"), F.col("_same")))
    names = list(features("span"))
    names = list(features("span"))
    place = F.pmod(F.xxhash64(*KEY, "span.start", "span.end"), F.lit(1 << 30)) / float(1 << 30)
    rows = materialize(rows.withColumns(features("span")).withColumn("_training", place < TRAINING), "features")
    # Proposals that look alike are one row with a weight.
    training = rows.filter("_training").groupBy("label", *names).agg(F.count("*").cast("double").alias("weight"))
    training = materialize(training, "training")
    if training.select("label").distinct().count() < 2:
        return None
    vectors = VectorAssembler(inputCols=names, outputCol="features")
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=7, stepSize=0.3, weightCol="weight")
    model = trees.fit(vectors.transform(training))
    score = vector_to_array("probability")[1]
    ranked = model.transform(vectors.transform(rows.filter("NOT _near"))).select(*KEY, "span", "label", "_training", score.alias("score"))
    ranked = materialize(ranked, "scores")
    bound = reduce(
        lambda c, r: c.when(F.col("span.kind") == r[0], r[1]), thresholds(ranked.filter("NOT _training")), F.when(F.lit(False), 2.0)
    )
    return ranked.select(*KEY, "span", "score", bound.otherwise(2.0).alias("threshold"))


def thresholds(ranked: DataFrame) -> list:
    """``kind`` and the least score from which ``PRECISION`` of its proposals are personal data, for kinds that reach it.

    Equal scores of a kind are one row; these are counted over ranges, the kinds one behind the other."""
    counts = ranked.groupBy(F.col("span.kind").alias("kind"), "score").agg(
        F.count("*").alias("_n"), F.sum(F.col("label").cast("bigint")).alias("_right")
    )
    totals = running_totals(materialize(counts, "counts"), ["kind", F.desc("score")], {"_n": "_all", "_right": "_all_right"})
    totals = materialize(totals, "totals")
    before = totals.groupBy("kind").agg(
        F.min(F.col("_all") - F.col("_n")).alias("_n_before"), F.min(F.col("_all_right") - F.col("_right")).alias("_right_before")
    )
    precise = (F.col("_all_right") - F.col("_right_before")) / (F.col("_all") - F.col("_n_before"))
    found = totals.join(before, "kind").filter(precise >= PRECISION).groupBy("kind").agg(F.min("score"))
    return found.collect()  # a row per kind


def personal_data(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``base`` and ``added`` spans (kind, start, end) of every row."""
    found = materialize(proposed(docs), "spans")
    extra = scored(found.distinct())
    plain = lambda spans: F.transform(spans, lambda s: F.struct(s["kind"], s["start"], s["end"]))
    result = found.select(*KEY, plain("base").alias("base"))
    nothing = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    if extra is None:
        return result.select("doc_id", "base", nothing.alias("added"))
    taken = extra.filter(F.col("score") >= F.col("threshold")).groupBy(*KEY)
    added = taken.agg(F.collect_set(F.struct("span.kind", "span.start", "span.end")).alias("_added"))
    return of_documents(result, added, "left").select(
        "doc_id", "base", F.coalesce("_added", nothing).alias("added")
    )


def written(spans: Column) -> Column:
    """kind:start:end of the spans, by start and then kind as listed, ``secret`` last."""
    rank = lambda s: reduce(lambda c, k: c.when(s["kind"] == k[1], k[0]), enumerate(ALL_KINDS), F)
    ordered = F.sort_array(
        F.transform(spans, lambda s: F.struct(s["start"], rank(s).alias("rank"), s["end"], s["kind"]))
    )
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
