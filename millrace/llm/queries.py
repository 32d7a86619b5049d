"""The operators of this folder bound to the input tables, each beside SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.decontamination import leaks
from millrace.llm.collocations import collocations
from millrace.llm.common import text_of, words_of
from millrace.llm.encoding import vocabulary
from millrace.llm.exact_dedup import exact_duplicates
from millrace.llm.language import fit, held_out, predict
from millrace.llm.line_dedup import apply_bitmaps, line_bitmaps
from millrace.llm.packing import pack_documents
from millrace.llm.periodic_runs import collapse_runs
from millrace.llm.pii import KINDS, personal_data, written
from millrace.llm.quality import judged
from millrace.llm.simhash import near_duplicates
from millrace.llm.substring_dedup import remove_repeats
from millrace.llm.token_counts import apply_edits, replacements, with_trees
from millrace.llm.token_files import checksums, read_tokens, write_tokens
from millrace.scratch import materialize, scratch_path
from millrace.tables import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


@query(
    r"""
    WITH lines AS (
        SELECT doc_id, i, line, lower_key AS key FROM (
            SELECT doc_id, unnest(range(len(parts))) AS i, unnest(parts) AS line,
                   translate(trim(unnest(parts), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_key
            FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
        )
    ),
    frequent AS (
        SELECT key FROM lines WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10
    )
    SELECT doc_id, count(*) AS n_lines, count(f.key) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE f.key IS NULL), '')) AS kept_sha256
    FROM lines LEFT JOIN frequent f ON lines.key = f.key
    GROUP BY doc_id
    """
)
def op1_line_dedup(spark, sf_dir):
    """Documents without the lines that stand in ten documents or more."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = apply_bitmaps(docs, line_bitmaps(docs, min_docs=10, keep_first=False))
    sha = F.sha2(F.coalesce("text", F.lit("")), 256)
    return kept.select("doc_id", "_bitmap.n_lines", "_bitmap.n_dropped", sha.alias("kept_sha256"))


@query()
def op2_substring_dedup(spark, sf_dir):
    """Documents without the words of 20-word windows that stand earlier."""
    kept = remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@query()
def op3_simhash(spark, sf_dir):
    """Documents with their fingerprint and the smallest id of their class."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


@query()
def op4_decontamination(spark, sf_dir):
    """Documents that hold a benchmark item, with the item."""
    found = leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_windows", "n_matched")


@query()
def op5_quality_rules(spark, sf_dir):
    """Counts of every document and whether the rules keep it."""
    found = judged(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return found.select("doc_id", *counts, "base_failed", "kept", F.array_join("broken", ",").alias("broken"))


@query()
def op6_packing(spark, sf_dir):
    """Pieces of all documents in windows of 4,096 ids, with checksums of their ids."""
    packed = pack_documents(table(spark, sf_dir, "documents"), vocabulary())
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query()
def op7_token_files(spark, sf_dir):
    """Documents as the ORC files hold them, with checksums of their ids."""
    path = scratch_path(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), path, vocabulary())
    return checksums(read_tokens(spark, path))


@query()
def op8_language_id(spark, sf_dir):
    """Predicted language of all documents, from centroids of those that are not held out."""
    docs = table(spark, sf_dir, "documents")
    found = predict(docs.select("doc_id", "text"), fit(docs))
    return found.select("doc_id", held_out().alias("held_out"), "language.*")


@query()
def op9_pii(spark, sf_dir):
    """Spans of personal data in all documents."""
    found = personal_data(table(spark, sf_dir, "documents"))
    of_kind = lambda kind: lambda s: s["kind"] == kind
    counts = [
        F.size(F.filter("base", of_kind(kind))).cast("bigint").alias(f"n_{kind}")
        for kind in KINDS
    ]
    base = F.sha2(written(F.col("base")), 256).alias("base_sha256")
    return found.select("doc_id", *counts, base, written(F.concat("base", "added")).alias("spans"))


@query()
def op10_token_counts(spark, sf_dir):
    """Token counts of all documents, before and after every run of five or more digits and every
    word with an at sign is replaced by a short word."""
    docs = with_trees(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary())
    # Written, so that a task has one Python process with its vocabulary at a time.
    docs = materialize(docs, "trees")
    edits = replacements("[0-9]{5,}|(?<![^ \\n])[^ \\n@]++@[^ \\n@]++(?![^ \\n])", "redacted")
    before = docs.withColumns({"edits": edits, "n_before": F.col("n_tokens"), "n_chars": F.length("text")})
    after = apply_edits(before, vocabulary())
    return after.select(
        "doc_id",
        F.col("n_before").alias("n_tokens"),
        F.size("edits").cast("bigint").alias("n_edits"),
        F.col("n_tokens").alias("n_tokens_edited"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("edited_sha256"),
        F.col("n_encoded").alias("chars_encoded"),
    )


@query(
    """
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
           doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """
)
def op11_exact_dedup(spark, sf_dir):
    """All documents with the one that stays of their equals."""
    found = exact_duplicates(spark, f"{sf_dir}/documents.parquet", scratch_path(spark, "met-texts"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def looped(doc_id: Column) -> Column:
    """The text, for one document in ten with a stretch up to its end replaced by repetitions of the
    words that it starts with."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = words_of(text_of())
    n = F.size(words)
    first = (g % n).cast("int")
    period = (F.lit(1) + F.floor((n - first) / (F.lit(3) + g % 8))).cast("int")
    times = F.ceil((n - first) / period).cast("int")
    looping = F.flatten(F.array_repeat(F.slice(words, first + 1, period), times))
    turned = F.concat(F.slice(words, F.lit(1), first), F.slice(looping, F.lit(1), n - first))
    return F.when((h % 10 == 0) & (n > 0), F.array_join(turned, " ")).otherwise(F.col("text"))


@query()
def op12_periodic_runs(spark, sf_dir):
    """Runs of repeating words in all documents, one in ten of which is made to end in a loop, and
    the texts without the repetitions."""
    docs = table(spark, sf_dir, "documents")
    found = collapse_runs(docs.select("doc_id", looped(F.col("doc_id")).alias("text")))
    order = F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("_s"), (-r["period"]).alias("_p")))
    longest = F.array_max(order)
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    return found.withColumn("_longest", longest).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        (-F.col("_longest._s")).alias("start"),
        F.col("_longest.length").alias("length"),
        (-F.col("_longest._p")).alias("period"),
        F.floor(1000 * F.col("_longest.length") / -F.col("_longest._p")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("text", 256).alias("collapsed_sha256"),
    )


@query(
    r"""
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents
    ),
    worded AS (
        SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS words FROM pieces
    ),
    places AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM worded),
    phrases AS (
        SELECT lang, k, array_to_string(words[i : i + k - 1], ' ') AS phrase
        FROM places, (SELECT unnest(range(1, 6)) AS k) WHERE i + k - 1 <= len(words)
    ),
    counts AS (SELECT lang, k, phrase, count(*)::HUGEINT AS f FROM phrases GROUP BY ALL),
    totals AS (SELECT lang, sum(f)::HUGEINT AS n FROM counts WHERE k = 1 GROUP BY lang),
    candidates AS (SELECT lang, k AS size, phrase, f AS a, string_split(phrase, ' ') AS words FROM counts WHERE k >= 2 AND f >= 100),
    cuts AS (
        SELECT lang, phrase, a, c, array_to_string(words[1 : c], ' ') AS one, array_to_string(words[c + 1 :], ' ') AS other
        FROM (SELECT *, unnest(range(1, size)) AS c FROM candidates)
    ),
    scored AS (
        SELECT cuts.lang, cuts.phrase, a, c, x.f AS l, y.f AS r, n, (1000 * a * n) // (x.f * y.f) AS score
        FROM cuts JOIN counts x ON x.lang = cuts.lang AND x.phrase = one
        JOIN counts y ON y.lang = cuts.lang AND y.phrase = other JOIN totals ON totals.lang = cuts.lang
    ),
    weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
    inner_phrases AS (
        SELECT lang, a, array_to_string(words[i : i + k - 1], ' ') AS phrase
        FROM (SELECT *, unnest(range(1, size)) AS i FROM candidates), (SELECT unnest(range(2, 5)) AS k)
        WHERE i + k - 1 <= size AND k < size
    ),
    kept AS (
        SELECT * FROM weakest w WHERE NOT EXISTS (
            SELECT 1 FROM inner_phrases p WHERE p.lang = w.lang AND p.phrase = w.phrase AND 100 * p.a >= 100 * w.a)
    )
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
           phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
    FROM kept QUALIFY rank <= 2000
    """
)
def op13_collocations(spark, sf_dir):
    """The 2,000 collocations of each language that score highest."""
    return collocations(table(spark, sf_dir, "documents"))
