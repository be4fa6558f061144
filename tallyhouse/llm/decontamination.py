"""Benchmark decontamination with a distributed positional inverted index.

Items are cut into windows of `width` words (a shorter item is one window). Their terms are counted in all
documents; a window with a term that no document has cannot occur. Of every other window the `probes` rarest
terms are looked up: the index stores the postings (term, row, position) of those terms over all documents.
A posting minus the term's place in the item is where the item would start, so lists adjusted in this way
are intersected by grouping on (row, item, start). A window whose probes all agree on a start is compared
word by word with the document, which gives the exact phrase matches; postings whose starts agree up to a
slop give proximity matches.

All of it is DataFrame functions. Term tables are joined by what their measured size allows: Spark
broadcasts them below its threshold, and beyond it both sides are shuffled.

Words are runs of ASCII letters and digits and of all characters beyond ASCII, A-Z lower-cased. Null or empty
texts have no words and no matches; items without words have no windows. Rows with the same id are judged
each by their own text. Items that repeat an id count once for it; items without an id match like all others,
count as one item together and stand as a null at the end of the ids. Empty tables give no matches. Further
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyhouse.llm.work_tables import WorkTables

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: A term table of up to so many bytes may be sent to every executor.
BROADCAST_BYTES = 16 << 20


def words_of(text: Column) -> Column:
    """The words of a text; null for a null text."""
    lowered = F.translate(text, UPPER, UPPER.lower())
    return F.array_remove(F.split(lowered, BETWEEN_WORDS), "")


def _small(terms: DataFrame) -> DataFrame:
    """terms, marked for broadcasting if it is measured to be small enough."""
    size = terms.agg(F.sum(F.octet_length("term") + 40)).first()[0] or 0
    return F.broadcast(terms) if size <= BROADCAST_BYTES else terms


def item_windows(items: DataFrame, width: int) -> DataFrame:
    """item, at (place of the window in the item), phrase (its words); once for each different window."""
    words = items.select(
        F.col("item_id").cast("string").alias("item"), words_of(F.col("text")).alias("words")
    ).where(F.size("words") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - width, F.lit(0)))
    # A null adds nothing to a hash, so that the next value would take its place
    named = F.struct(F.col("item").isNull().alias("none"), F.coalesce("item", F.lit("")).alias("id"))
    return (
        words.withColumn("text_id", F.xxhash64(named, "words"))
        .dropDuplicates(["text_id"])
        .select("item", "text_id", "words", F.explode(starts).alias("at"))
        .select("item", "text_id", "at", F.slice("words", F.col("at") + 1, width).alias("phrase"))
    )


class BenchmarkIndex:
    """Probes of the items' windows and the documents' postings of their terms.

    rows: documents as (doc_id, row_id, text). probes: (item, text_id, at, term, offset, rank), offset being
    the term's place in the item. postings: (term, row_id, position). A text_id stands for one item, which may
    be null, and its words; joins are by text_id alone.
    """

    def __init__(self, documents: DataFrame, items: DataFrame, *, width: int = 13, probes: int = 3) -> None:
        self.work = WorkTables(documents.sparkSession, "decontamination")
        self.rows = documents.select("doc_id", "text").withColumn("row_id", F.xxhash64("doc_id", "text"))
        self.windows = self.work.keep(item_windows(items, width), "windows")
        terms = self.windows.select(F.explode("phrase").alias("term")).distinct()
        terms = self.work.keep(terms, "terms")
        counts = self.work.keep(
            self._occurrences(terms).groupBy("term").agg(F.count("*").alias("n")), "counts"
        )
        placed = self.windows.select("item", "text_id", "at", F.posexplode("phrase").alias("k", "term"))
        rarest = Window.partitionBy("item", "text_id", "at").orderBy("n", "k")
        whole = Window.partitionBy("item", "text_id", "at")
        self.probes = self.work.keep(
            placed.join(counts, "term", "left")
            .withColumn("n", F.coalesce("n", F.lit(0)))
            .withColumn("least", F.min("n").over(whole))
            .withColumn("rank", F.row_number().over(rarest))
            .where((F.col("least") > 0) & (F.col("rank") <= probes))
            .select("item", "text_id", "at", "term", (F.col("at") + F.col("k")).alias("offset"), "rank"),
            "probes",
        )
        self.postings = self.work.keep(
            self._occurrences(self.probes.select("term").distinct()), "postings"
        )

    def _occurrences(self, terms: DataFrame) -> DataFrame:
        every = self.rows.select("row_id", F.posexplode(words_of(F.col("text"))).alias("position", "term"))
        return every.join(_small(terms), "term")

    def phrase_matches(self) -> DataFrame:
        """row_id, item, start, length: every exact occurrence of a window, in words of the document."""
        places = self.probes.select("text_id", "offset", "term").distinct()
        starts = (
            self.postings.join(places, "term")
            .withColumn("start", F.col("position") - F.col("offset"))
            .groupBy("row_id", "text_id", "start")
            .agg(F.collect_set("offset").alias("agreed"))
        )
        wanted = (
            self.probes.groupBy("text_id", "at")
            .agg(F.collect_set("offset").alias("offsets"))
            .join(self.windows, ["text_id", "at"])
        )
        candidates = (
            starts.join(wanted, "text_id")
            .where(F.size(F.array_except("offsets", "agreed")) == 0)
            .where(F.col("start") + F.col("at") >= 0)
            .groupBy("row_id")
            .agg(
                F.collect_set(
                    F.struct("item", (F.col("start") + F.col("at")).alias("start"), "phrase")
                ).alias("candidates")
            )
        )
        candidates = self.work.keep(candidates, "candidates")
        return (
            self.rows.select("row_id", "text")
            .join(candidates, "row_id")
            .dropDuplicates(["row_id"])
            .select("row_id", words_of(F.col("text")).alias("words"), "candidates")
            .select(
                "row_id",
                F.explode(
                    F.filter(
                        "candidates",
                        lambda c: F.slice("words", c.start + 1, F.size(c.phrase)) == c.phrase,
                    )
                ).alias("c"),
            )
            .select("row_id", "c.item", "c.start", F.size("c.phrase").alias("length"))
        )

    def proximity_matches(self, slop: int) -> DataFrame:
        """row_id, item, at, start, spread: windows whose probes occur in their order up to `slop` words."""
        key = ["row_id", "text_id", "at"]
        seen = self.postings.join(self.probes, "term").select(
            *key, "item", "rank", (F.col("position") - F.col("offset")).alias("start")
        )
        first = seen.where(F.col("rank") == 1).select(*key, F.col("start").alias("anchor"))
        n_probes = self.probes.groupBy("text_id", "at").agg(F.count("*").alias("n_probes"))
        return (
            first.join(seen, key)
            .where(F.abs(F.col("start") - F.col("anchor")) <= slop)
            .groupBy(*key, "item", "anchor")
            .agg(
                F.count_distinct("rank").alias("agreed"),
                F.min("start").alias("start"),
                (F.max("start") - F.min("start")).alias("spread"),
            )
            .join(n_probes, ["text_id", "at"])
            .where(F.col("agreed") == F.col("n_probes"))
            .select("row_id", "item", "at", (F.col("start") + F.col("at")).alias("start"), "spread")
            .distinct()
        )


def judge_documents(
    documents: DataFrame, items: DataFrame, *, width: int = 13, probes: int = 3, share: int = 20
) -> DataFrame:
    """doc_id, row_id, n_words, n_hit, n_items, items (sorted ids) and contaminated of every row.

    n_hit counts the words inside occurrences of windows; a document is contaminated if it has some and
    share * n_hit >= n_words.
    """
    index = BenchmarkIndex(documents, items, width=width, probes=probes)
    hits = index.work.keep(index.phrase_matches(), "hits")
    end = F.col("start") + F.col("length")
    before = Window.partitionBy("row_id").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    covered = (
        hits.select("row_id", "start", end.alias("end"))
        .distinct()
        .withColumn("covered", F.coalesce(F.max("end").over(before), F.lit(0)))
        .groupBy("row_id")
        .agg(
            F.sum(F.greatest(F.col("end") - F.greatest("start", "covered"), F.lit(0))).alias("n_hit")
        )
    )
    # A set of bare ids would leave the null out
    ids = F.transform(F.collect_set(F.struct("item")), lambda x: x["item"])
    found = hits.groupBy("row_id").agg(F.array_sort(ids).alias("items"))
    judged = index.work.keep(covered.join(found, "row_id"), "judged")
    n_words = F.coalesce(F.size(words_of(F.col("text"))), F.lit(0))
    counted = index.rows.select("doc_id", "row_id", F.greatest(n_words, F.lit(0)).cast("long").alias("n_words"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    ids = F.coalesce("items", F.array().cast("array<string>"))
    return counted.join(judged, "row_id", "left").select(
        "doc_id",
        "row_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        ids.alias("items"),
        ((n_hit > 0) & (n_hit * share >= F.col("n_words"))).alias("contaminated"),
    )
