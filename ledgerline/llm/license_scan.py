"""License scan by diagonal voting.

Every document's rolling ``K``-word windows are joined to the positions of the
same window in the license templates. A hit at document word p and template
word q votes for the diagonal p - q, the place where the template would start;
votes are summed per (document, template, diagonal), neighbouring diagonals
whose spans lie next to each other (a word put in or left out) are merged, and
a merged span counts when enough of the template's words are aligned in it,
words put in or left out between them aside, and all windows of its key phrases
are. Hits are joined on the words themselves beside their hash, so every vote
is verified and a diagonal with all windows of a template is an exact
occurrence. Templates are a table (label, text, keys); several texts may have
one label.

Defined cases: null and empty texts have no words, no labels and score 0;
long texts are scanned whole, only windows that occur in a template leave the
scan; repeated rows are scanned one by one; an empty table gives an empty
result; only the key and the text are read, so other columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .columns import let, plain_words
from .license_texts import TEXTS
from .tables import BROADCAST_ROWS, stored

K = 3
SLACK = 3            # words that may be put in or left out between two diagonals
MIN_COVERAGE = 0.75  # words of a template that a span must hold

# The base phrases and their labels.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

_WINDOWS = "template, label, size, at, window, need, needs"


def standard_templates(spark: SparkSession) -> DataFrame:
    """(label, text, keys) of ``license_texts``, a table of fixed size."""
    return spark.sql("SELECT * FROM VALUES " + ", ".join(
        "(" + ", ".join(_quoted(x) for x in row) + ")" for row in TEXTS) + " AS t(label, text, keys)")


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _needed(words: list[str], keys: list[list[str]], k: int) -> set[int]:
    """Places of the windows of the key phrases."""
    needed: set[int] = set()
    for key in keys:
        at = next((i for i in range(len(words) - len(key) + 1) if words[i:i + len(key)] == key),
                  None)
        if at is None or len(key) < k:
            raise ValueError(f"{key} is no phrase of {k} words or more of {words}")
        needed |= set(range(at, at + len(key) - k + 1))
    return needed


def template_windows(templates: DataFrame, k: int = K, first: int = 0) -> DataFrame:
    """One row per window of a template, from (label, text, keys). The table is
    small (licenses, not documents) and goes through the driver; templates of
    less than ``k`` words have no window."""
    rows = []
    read = templates.select("label", plain_words(F.col("text")).alias("words"), F.transform(
        F.split(F.coalesce("keys", F.lit("")), r"\|"), plain_words).alias("keys")).collect()
    for i, r in enumerate(read, first):
        needed = _needed(r.words, [x for x in r["keys"] if x], k)
        rows += [f"({i}, {_quoted(r.label)}, {len(r.words)}, {j}, "
                 f"{_quoted(' '.join(r.words[j:j + k]))}, {str(j in needed).lower()}, {len(needed)})"
                 for j in range(len(r.words) - k + 1)]
    if not rows:
        return templates.sparkSession.sql(
            "SELECT 0 AS template, '' AS label, 0 AS size, 0 AS at, '' AS window, false AS need, "
            "0 AS needs WHERE false")
    return templates.sparkSession.sql(
        "SELECT * FROM VALUES " + ", ".join(rows) + f" AS t({_WINDOWS})")


def _hits(text: Column, hashes: list[int], k: int) -> Column:
    """struct(n_words, hits): the windows of a text that some template holds,
    with their place and words."""
    def of(words: Column) -> Column:
        places = F.filter(F.sequence(F.lit(1), F.size(words) - (k - 1)),
                          lambda i: F.xxhash64(F.slice(words, i, k)).isin(hashes))
        hits = F.transform(places, lambda i: F.struct(
            (i - 1).cast("long").alias("p"), F.concat_ws(" ", F.slice(words, i, k)).alias("window")))
        empty = F.array().cast("array<struct<p:bigint,window:string>>")
        return F.struct(F.size(words).cast("long").alias("n_words"),
                        F.when(F.size(words) >= k, hits).otherwise(empty).alias("hits"))
    return let(plain_words(text), of)


def diagonal_votes(hits: DataFrame, windows: DataFrame) -> DataFrame:
    """Votes per (row, template, diagonal) from (row, p, window)."""
    return (hits.join(F.broadcast(windows), "window")
            .groupBy("row", "template", "label", "size", "needs",
                     (F.col("p") - F.col("at")).alias("diagonal"))
            .agg(F.count(F.lit(1)).alias("votes"), F.min("p").alias("first"),
                 F.max("p").alias("last"), F.collect_set("at").alias("ats"),
                 F.collect_set(F.when(F.col("need"), F.col("at"))).alias("needed")))


def merged_spans(votes: DataFrame, k: int = K, slack: int = SLACK) -> DataFrame:
    """Neighbouring diagonals of one template, merged into spans.

    A diagonal joins the one before it (in text order) when it differs by at
    most ``slack`` words and starts no later than ``slack`` words after the
    other's end."""
    order = Window.partitionBy("row", "template").orderBy("first", "diagonal")
    apart = ((F.abs(F.col("diagonal") - F.lag("diagonal").over(order)) > slack)
             | (F.col("first") > F.lag("last").over(order) + (k + slack)))
    marked = votes.withColumn("new", F.coalesce(apart, F.lit(True)).cast("int"))
    numbered = marked.withColumn("span", F.sum("new").over(
        order.rowsBetween(Window.unboundedPreceding, 0)))
    aligned = F.array_distinct(F.flatten(F.transform(
        F.flatten(F.collect_list("ats")), lambda at: F.sequence(at, at + (k - 1)))))
    return numbered.groupBy("row", "template", "label", "size", "needs", "span").agg(
        F.sum("votes").alias("votes"), F.min("first").alias("first"),
        (F.max("last") + (k - 1)).alias("last"), F.max("votes").alias("best"),
        F.count(F.lit(1)).alias("diagonals"), F.size(aligned).alias("aligned"),
        F.size(F.array_distinct(F.flatten(F.collect_list("needed")))).alias("held"))


def scan(documents: DataFrame, key: str = "doc_id", text: str = "text",
         min_coverage: float = MIN_COVERAGE,
         templates: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(documents, spans): ``row``, ``doc_id``, ``n_words`` of every document,
    and the verified spans (row, template, label, first, last, coverage, base,
    start of each exact base phrase). ``templates`` is a table (label, text,
    keys), the standard one if not given; its windows are broadcast, so a table
    of more than ``BROADCAST_ROWS`` of them is refused."""
    spark = documents.sparkSession
    phrases = spark.sql("SELECT * FROM VALUES " + ", ".join(
        f"({_quoted(label)}, {_quoted(phrase)}, '')" for phrase, label in BASE_PHRASES.items())
        + " AS t(label, text, keys)")
    windows = template_windows(phrases).unionByName(template_windows(
        standard_templates(spark) if templates is None else templates, first=len(BASE_PHRASES)))
    if windows.count() > BROADCAST_ROWS:
        raise ValueError(f"templates of more than {BROADCAST_ROWS} windows have to be scanned in parts")
    hashes = [r[0] for r in windows.select(
        F.xxhash64(F.split("window", " "))).distinct().collect()]
    scanned = documents.select(F.col(key).alias("doc_id"),
                               _hits(F.col(text), hashes, K).alias("s"))
    rows = stored(scanned.select(F.monotonically_increasing_id().alias("row"), "doc_id",
                                 "s.n_words", "s.hits"), "license-hits")
    hits = rows.select("row", F.inline("hits"))
    votes = diagonal_votes(hits, windows)
    spans = merged_spans(votes)
    n_base = len(BASE_PHRASES)
    counted = spans.where(F.col("held") == F.col("needs")).withColumn(
        "coverage", F.col("aligned") / F.col("size"))
    exact = votes.where((F.col("template") < n_base) & (F.col("votes") == F.col("size") - (K - 1)))
    verified = (counted.where((F.col("template") >= n_base) & (F.col("coverage") >= min_coverage))
                .select("row", "template", "label", "first", "last", "coverage",
                        F.lit(False).alias("base"))
                .unionByName(exact.select(
                    "row", "template", "label", F.col("diagonal").alias("first"),
                    (F.col("diagonal") + F.col("size") - 1).alias("last"),
                    F.lit(1.0).alias("coverage"), F.lit(True).alias("base"))))
    return rows.select("row", "doc_id", "n_words"), verified


def label_documents(documents: DataFrame, key: str = "doc_id", text: str = "text",
                    templates: DataFrame | None = None) -> DataFrame:
    """Counts, labels and score of every document."""
    rows, spans = scan(documents, key, text, templates=templates)

    def labels(only: Column) -> Column:
        return F.array_join(F.sort_array(F.collect_set(F.when(only, F.col("label")))), ",")

    found = spans.groupBy("row").agg(
        F.sum(F.col("base").cast("long")).alias("n_base"),
        F.min(F.when(F.col("base"), F.col("first"))).alias("first_word"),
        F.max(F.when(F.col("base"), F.col("first"))).alias("last_word"),
        labels(F.col("base")).alias("base_labels"), labels(F.lit(True)).alias("labels"),
        F.max("coverage").alias("score"))
    return rows.join(found, "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        F.col("first_word").cast("long").alias("first_word"),
        F.col("last_word").cast("long").alias("last_word"),
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).cast("double").alias("score"))
