"""Near-duplicate classes by an n-gram Jaccard join with adaptive multi-match prefixes.

A text is the set of its 5-word shingles, as 64-bit hashes in one global order. Two sets of Jaccard at least t
share at least `m` of their first `n - ceil(t n) + m` shingles: a longer prefix demands more shared
shingles. Every text starts at the shortest level. A text whose prefix shares too few shingles with any
other is done. For the rest the candidates are estimated by how many other texts the lists of their shared
shingles hold, in the mean and together. The more there are, the longer the prefix the text goes on with, and the more
matches a pair needs before it is verified; the longest is the whole set, where matches are overlaps.

1. Copies (equal word sequences) are one text from the start, named by the hash of the sequence.
2. All texts show the prefixes of the shortest level, which says how much each shares with others, and so
   its level. Frequent shingles are counted in the task that makes them: beyond `LONG_LIST` texts of a task,
   only the smallest and the largest go on to stand for the list.
3. The texts that are left show the prefixes of their levels. In each shingle's list a few texts stand as
   hubs: the one that shares most, and some by the order of digests, the same in all lists. Texts with enough
   matches with a hub are verified against it. So a group of near copies of any size costs a few pairs for
   each member, and its pairs need not be listed.
4. Shingles that lie in one component found so far cannot link two. Counting only the others, most texts
   have too few matches left. Of the rest, a pair of which one shows less than its whole set is joined
   shingle by shingle, and verified if it has the matches. Texts that show whole sets meet around their main
   hubs: so many that the shingles of the others are no more than a link may lack. Around a hub, those outside
   its largest component are held in blocks and all others stream past them, so no pair is listed.
   No link between two components is missed; links within one add nothing to it.

Null and empty texts, and texts without words, have no shingles, link with nothing and are their own
component; texts of fewer than 5 words have one shingle. Repeated rows and ids count as copies; a null id is
never a component's id unless all its ids are null. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from tallyhouse.llm.components import components
from tallyhouse.llm.text_arrays import NOT_BLANK, U, Words, mix, rolling, sequence_hash, words_of
from tallyhouse.llm.work_tables import WorkTables

#: Shared shingles demanded at each level, as hundredths of the text's shingles.
LEVELS = (4, 25, 75)
#: Up to how many candidates a text stays at a level: by the other texts in its shared shingles' lists in the
#: mean, and by all of them together, divided by the matches a candidate needs.
CANDIDATES = ((1.5, 8), (3, 16))
#: Texts of a task that share a shingle before the list is shortened there.
LONG_LIST = 32
#: Shingles gathered before a task gives them out.
FLUSH = 500_000
#: Texts that stand as hubs in a list: the one that shares most, and those that do if the share of each text
#: is raised by up to so many hundredths, by its digest.
HUBS, RAISED = 5, 5
#: Texts around a hub that a task holds while the others stream past them.
BLOCK_TEXTS = 256
#: Texts around a hub that stream past one copy of a block.
STREAM_TEXTS = 4096
#: Members that meet one copy of the text they are compared with.
MEMBERS_PER_GROUP = 512


def shingle_sets(words: Words, size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    grams = rolling(words.hash, size)
    whole = sequence_hash(words)
    out = []
    for a, b, sequence in zip(words.first[:-1].tolist(), words.first[1:].tolist(), whole, strict=True):
        if b - a >= size:
            out.append(np.unique(grams[a : b - size + 1]))
        else:
            out.append(np.array([sequence] if b > a else [], dtype=U))
    return out


def overlap_needed(n: int, hundredths: int) -> int:
    return -(-hundredths * n // 100)


def matches_at(n: int, level: int, hundredths: int) -> int:
    """Shared shingles that a text of n shingles demands at a level."""
    return min(overlap_needed(n, hundredths), max(1, -(-LEVELS[level] * n // 100)))


def _hundredth_up(x: Column) -> Column:
    return F.ceil(x / F.lit(100))


def _matches(n: Column, level: Column, hundredths: int) -> Column:
    """matches_at as a column."""
    share = F.get(F.array(*map(F.lit, LEVELS)), level)
    return F.least(_hundredth_up(n * hundredths), F.greatest(F.lit(1), _hundredth_up(n * share)))


def _least_matches(n: Column, own: Column, level: int, hundredths: int) -> Column:
    """What a text of n shingles and own matches shares at least with any partner at a level, whatever the
    partner's size. The bound is linear in that size, so it is lowest at t n or n / t; 2 allow for rounding."""
    t, f = hundredths / 100, LEVELS[level] / 100
    share = min(f * t + t - t * t, f / t)
    return F.greatest(F.lit(1), F.least(own, F.floor(n * share) - 2))


def _pair_matches(x: str, y: str, hundredths: int) -> Column:
    """What two texts that link share at least in their prefixes. Each prefix is by (overlap - needed of its
    own) longer than its level's matches ask for."""
    n, own = (lambda a, c: F.col(f"{a}.{c}")), (lambda a: _hundredth_up(F.col(f"{a}.n_shingles") * hundredths))
    overlap = F.ceil((n(x, "n_shingles") + n(y, "n_shingles")) * hundredths / F.lit(100 + hundredths))
    return F.least(*(n(a, "own") + overlap - own(a) for a in (x, y)))


def _texts(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for words in words_of(batches, table=NOT_BLANK, lower=True):
        n = np.array([len(s) for s in shingle_sets(words, size)], dtype=np.int64)
        key = pa.array(sequence_hash(words).view(np.int64), pa.int64(), mask=n == 0)
        rows = words.rows
        yield pa.RecordBatch.from_arrays(
            [rows.column("doc_id"), rows.column("row_id"), key, pa.array(n)],
            names=["doc_id", "row_id", "key", "n_shingles"],
        )


_FIRST = "shingle long, key long, counted int, others int"
_FIRST_SCHEMA = pa.schema(
    [("shingle", pa.int64()), ("key", pa.int64()), ("counted", pa.int32()), ("others", pa.int32())]
)


def _shorten(shingles: np.ndarray, keys: np.ndarray) -> pa.RecordBatch:
    """(shingle, key) rows. Of long lists only the smallest and largest key; for each other key, one row with
    the number of its shingles counted here and of the others in their lists."""
    order = np.lexsort((keys, shingles))
    s, k = shingles[order], keys[order]
    heads = np.flatnonzero(np.append(True, s[1:] != s[:-1]))
    size = np.diff(np.append(heads, len(s)))
    of = np.repeat(np.arange(len(heads)), size)
    place = np.arange(len(s)) - heads[of]
    inner = (size[of] > LONG_LIST) & (place > 0) & (place < size[of] - 1)
    key, at = np.unique(k[inner], return_inverse=True)
    counted = np.bincount(at, minlength=len(key))
    others = np.bincount(at, weights=size[of[inner]] - 1, minlength=len(key))
    none = np.zeros(int((~inner).sum()), dtype=np.int64)
    columns = (
        np.concatenate([s[~inner].view(np.int64), mix(key.view(U)).view(np.int64)]),
        np.concatenate([k[~inner], key]),
        np.concatenate([none, counted]),
        np.concatenate([none, np.minimum(others, 2**30).astype(np.int64)]),
    )
    arrays = [pa.array(c, f.type) for c, f in zip(columns, _FIRST_SCHEMA, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=_FIRST_SCHEMA)


def _first_prefixes(batches: Iterator[pa.RecordBatch], size: int, hundredths: int) -> Iterator[pa.RecordBatch]:
    seen: set[int] = set()
    shingles: list[np.ndarray] = []
    keys: list[np.ndarray] = []
    held = 0
    for words in words_of(batches, lower=True):
        names = sequence_hash(words).view(np.int64).tolist()
        for key, shown in zip(names, shingle_sets(words, size), strict=True):
            n = len(shown)
            if not n or key in seen:
                continue
            seen.add(key)
            shown = shown[: n - overlap_needed(n, hundredths) + matches_at(n, 0, hundredths)]
            shingles.append(shown.copy())
            keys.append(np.full(len(shown), key, dtype=np.int64))
            held += len(shown)
        if held >= FLUSH:
            yield _shorten(np.concatenate(shingles), np.concatenate(keys))
            shingles, keys, held = [], [], 0
            seen = set()
    if held:
        yield _shorten(np.concatenate(shingles), np.concatenate(keys))


def _level_prefixes(batches: Iterator[pa.RecordBatch], size: int, hundredths: int) -> Iterator[pa.RecordBatch]:
    for words in words_of(batches, lower=True):
        rows = words.rows
        fields = ("key", "standing")
        cols = [rows.column(f).to_numpy(zero_copy_only=False) for f in fields]
        shown = []
        for s, standing in zip(shingle_sets(words, size), cols[1].tolist(), strict=True):
            n, level = len(s), standing % len(LEVELS)
            shown.append(s[: n - overlap_needed(n, hundredths) + matches_at(n, level, hundredths)])
        counts = np.array([len(s) for s in shown], dtype=np.int64)
        kinds = (pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([np.empty(0, U), *shown]).view(np.int64))]
            + [pa.array(np.repeat(c, counts), t) for c, t in zip(cols, kinds, strict=True)],
            names=["shingle", *fields],
        )


def _compare(batches: Iterator[pa.RecordBatch], size: int, hundredths: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by group, the group's text first: links of the members with it."""
    group, hub = None, np.empty(0, dtype=U)
    for words in words_of(batches, lower=True):
        rows = words.rows
        found: dict[str, list[int]] = {"a": [], "b": []}
        columns = [rows.column(c).to_pylist() for c in ("b", "part", "a")]
        for b, part, a, shingles in zip(*columns, shingle_sets(words, size), strict=True):
            if a is None:
                group, hub = (b, part), shingles
                continue
            if group != (b, part):  # the text to compare with is gone from the input
                continue
            both = len(np.intersect1d(hub, shingles, assume_unique=True))
            if 100 * both >= hundredths * (len(hub) + len(shingles) - both):
                found["a"].append(a)
                found["b"].append(b)
        yield pa.RecordBatch.from_pydict(found, schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))


def verified(pairs: DataFrame, texts: DataFrame, size: int, hundredths: int) -> DataFrame:
    """The pairs (a, b) of keys whose texts link. A text compared with many gets a copy for every so many."""
    parts = F.ceil(F.count("*") / MEMBERS_PER_GROUP).cast("int")
    groups = pairs.groupBy("b").agg(parts.alias("parts"))
    members = (
        pairs.join(groups, "b")
        .join(texts.withColumnRenamed("key", "a"), "a")
        .select("b", F.pmod(F.xxhash64("a"), F.col("parts")).cast("int").alias("part"), "a", "text")
    )
    hubs = (
        groups.join(texts.withColumnRenamed("key", "b"), "b")
        .select("b", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "text")
        .select("b", "part", F.lit(None).cast("long").alias("a"), "text")
    )
    return (
        members.unionByName(hubs)
        .repartition("b", "part")
        .sortWithinPartitions("b", "part", F.col("a").asc_nulls_first())
        .mapInArrow(lambda batches: _compare(batches, size, hundredths), "a long, b long")
    )


def _sizes_allow(x: str, y: str, hundredths: int) -> Column:
    """Whether the smaller set is large enough to be most of the larger one."""
    sizes = F.col(f"{x}.n_shingles"), F.col(f"{y}.n_shingles")
    return 100 * F.least(*sizes) >= hundredths * F.greatest(*sizes)


def _whole(x: str, y: str) -> Column:
    """Whether both texts show their whole sets."""
    return (F.col(f"{x}.level") == len(LEVELS) - 1) & (F.col(f"{y}.level") == len(LEVELS) - 1)


def _hubs(draws: range, centrality: Column, by_shingle: WindowSpec) -> Column:
    """The keys that stand as hubs in each shingle's list, one for each draw."""
    orders = [centrality] if 0 in draws else []
    for r in draws[len(orders) :]:
        raised = F.pmod(F.xxhash64(F.lit(r), "key"), F.lit(10 * RAISED))
        orders.append(centrality * (1000 + raised))
    return F.array(*(F.max(F.struct(o.alias("order"), "key")).over(by_shingle)["key"] for o in orders))


def _with_hubs(listed: DataFrame, held: DataFrame, hundredths: int) -> DataFrame:
    """Pairs (a, b, whole) of held texts and hubs of their shingles that have enough matches."""
    matches = (
        listed.select("key", F.explode(F.array_distinct("hubs")).alias("hub"))
        .where(F.col("key") != F.col("hub"))
        .groupBy(F.least("key", "hub").alias("a"), F.greatest("key", "hub").alias("b"), "key")
        .agg(F.count("*").alias("matches"))
        .groupBy("a", "b")
        .agg(F.max("matches").alias("matches"))
        .alias("m")
    )
    return (
        matches.join(held.alias("x"), F.col("m.a") == F.col("x.key"))
        .join(held.alias("y"), F.col("m.b") == F.col("y.key"))
        .where(_sizes_allow("x", "y", hundredths) & (F.col("matches") >= _pair_matches("x", "y", hundredths)))
        .select("m.a", "m.b", _whole("x", "y").alias("whole"))
    )


def _links(pairs: DataFrame, texts: DataFrame, size: int, hundredths: int) -> DataFrame:
    """The candidates (a, b, whole) that link: those of whole sets, and those that their texts verify."""
    return pairs.where("whole").select("a", "b").unionByName(
        verified(pairs.where("NOT whole").select("a", "b"), texts, size, hundredths)
    )


def _around_hubs(crossing: DataFrame, whole: DataFrame, hundredths: int, work: WorkTables) -> DataFrame:
    """(hub, key, component, blocks, streams, outside): the texts that meet around each hub, into how many
    blocks those outside its main component go and into how many streams all of them do. A text leaves out the hubs of its
    fewest shingles, as long as those are no more than it may lack in a link. Two texts that link have
    more in common than both may leave out together, so they meet around one hub at least."""
    n = F.col("n_shingles")
    fewest = Window.partitionBy("key").orderBy("matches", "hub")
    kept = (
        crossing.groupBy("key", "hub")
        .agg(F.count("*").alias("matches"))
        .join(whole.select("key", "n_shingles", "component"), "key")
        .withColumn("all", F.sum("matches").over(Window.partitionBy("key")))
        .withColumn("upto", F.sum("matches").over(fewest))
        .where(F.col("all") >= _hundredth_up(n * hundredths))
        .where(F.col("upto") > F.col("all") - _hundredth_up(n * hundredths))
        .select("hub", "key", "component")
    )
    kept = work.keep(kept, "around")
    by_component = kept.groupBy("hub", "component").agg(F.count("*").alias("n"))
    main = by_component.groupBy("hub").agg(
        F.max(F.struct("n", "component"))["component"].alias("main"),
        F.sum("n").alias("n"),
        F.max("n").alias("n_main"),
    )
    blocks = F.ceil((F.col("n") - F.col("n_main")) / BLOCK_TEXTS).cast("int")
    streams = F.ceil(F.col("n") / STREAM_TEXTS).cast("int")
    some = main.where(F.col("n") > F.col("n_main")).select(
        "hub", "main", blocks.alias("blocks"), streams.alias("streams")
    )
    return kept.join(some, "hub").withColumn("outside", F.col("component") != F.col("main")).drop("main")


def _meet(batches: Iterator[pa.RecordBatch], size: int, hundredths: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by group, in it the held texts first: links that join two components, each once in a group."""
    group, held, label = None, None, {}

    def root(component: int) -> int:
        while label.setdefault(component, component) != component:
            component = label[component]
        return component

    for words in words_of(batches, lower=True):
        found: dict[str, list[int]] = {"a": [], "b": []}
        names = ("hub", "block", "stream", "passes", "key", "component")
        columns = [words.rows.column(c).to_pylist() for c in names]
        for *of, passes, key, component, shown in zip(*columns, shingle_sets(words, size), strict=True):
            if group != of:
                group, held, label = of, _Held(), {}
            if not passes:
                held.add(key, component, shown)
                continue
            for other, other_component in held.links(shown, hundredths):
                one, two = root(component), root(other_component)
                if one != two:
                    label[one] = two
                    found["a"].append(key)
                    found["b"].append(other)
        yield pa.RecordBatch.from_pydict(found, schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))


class _Held:
    """Some texts' shingles, looked up together."""

    def __init__(self) -> None:
        self.keys: list[tuple[int, int]] = []
        self.sets: list[np.ndarray] = []
        self.shingles: np.ndarray | None = None

    def add(self, key: int, component: int, shingles: np.ndarray) -> None:
        self.keys.append((key, component))
        self.sets.append(shingles)

    def links(self, shown: np.ndarray, hundredths: int) -> list[tuple[int, int]]:
        if not self.sets:
            return []
        if self.shingles is None:
            owner = np.repeat(np.arange(len(self.sets)), [len(s) for s in self.sets])
            every = np.concatenate(self.sets)
            order = np.argsort(every, kind="stable")
            self.owner, every = owner[order], every[order]
            self.start = np.flatnonzero(np.append(True, every[1:] != every[:-1]))
            self.shingles = every[self.start]
            self.start = np.append(self.start, len(every))
            self.sizes = np.array([len(s) for s in self.sets])
        at = np.searchsorted(self.shingles, shown)
        at = at[self.shingles[np.minimum(at, len(self.shingles) - 1)] == shown]
        first, count = self.start[at], self.start[at + 1] - self.start[at]
        place = np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())
        both = np.bincount(self.owner[place], minlength=len(self.sets))
        linked = np.flatnonzero(100 * both >= hundredths * (self.sizes + len(shown) - both))
        return [self.keys[i] for i in linked]


def _block_links(around: DataFrame, texts: DataFrame, size: int, hundredths: int) -> DataFrame:
    """Links (a, b) between components, found around hubs; every text meets all held ones of its hubs."""
    placed = around.join(texts, "key")

    def numbers(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    def one_of(count: str) -> Column:
        return F.pmod(F.xxhash64("key"), F.col(count)).cast("int")

    rest = ["key", "component", "text"]
    held = placed.where("outside").select(
        "hub", one_of("blocks").alias("block"), numbers("streams").alias("stream"), F.lit(False).alias("passes"), *rest
    )
    passing = placed.select(
        "hub", numbers("blocks").alias("block"), one_of("streams").alias("stream"), F.lit(True).alias("passes"), *rest
    )
    return (
        held.unionByName(passing)
        .repartition("hub", "block", "stream")
        .sortWithinPartitions("hub", "block", "stream", "passes")
        .mapInArrow(lambda batches: _meet(batches, size, hundredths), "a long, b long")
    )


def near_duplicate_classes(
    documents: DataFrame, *, shingle_words: int = 5, hundredths: int = 75
) -> DataFrame:
    """doc_id, row_id, n_shingles, component_id (the smallest id) and component (a name that no other component
    has; null without shingles) of every row; texts link at Jaccard >= hundredths / 100."""
    work = WorkTables(documents.sparkSession, "ngram-join")
    size, t = shingle_words, hundredths
    rows = documents.select("doc_id", "text").withColumn("row_id", F.xxhash64("doc_id", "text"))
    members = work.keep(
        rows.mapInArrow(lambda b: _texts(b, size), "doc_id long, row_id long, key long, n_shingles long"),
        "members",
    )
    distinct = (
        members.where(F.col("key").isNotNull())
        .groupBy("key", "n_shingles")
        .agg(F.min("row_id").alias("row_id"), F.min("doc_id").alias("doc_id"))
    )

    by_shingle = Window.partitionBy("shingle")
    n, own = F.col("n_shingles"), F.col("own")
    in_task = F.col("counted") > 0
    shares = (
        rows.select("text")
        .mapInArrow(lambda b: _first_prefixes(b, size, t), _FIRST)
        .withColumn("low", F.min("key").over(by_shingle))
        .withColumn("high", F.max("key").over(by_shingle))
        .withColumn("list", F.count("*").over(by_shingle))
        .where(in_task | (F.col("low") < F.col("high")))
        .groupBy("key")
        .agg(
            F.sum(F.when(in_task, F.col("counted")).otherwise(1)).alias("matches"),
            F.sum(F.when(in_task, F.col("others")).otherwise(F.col("list") - 1)).alias("others"),
            F.sum("counted").alias("in_long_lists"),
        )
    )
    prefix = n - _hundredth_up(n * t) + own
    # Lists that tasks shortened are longer than they counted; too few of these make no candidate
    few = [
        (F.col("others") <= mean * F.col("matches"))
        & (F.col("others") <= together * own)
        & (F.col("in_long_lists") < own)
        for mean, together in CANDIDATES
    ]
    sharing = (
        shares.join(distinct, "key")
        .withColumn("own", _matches(n, F.lit(0), t))
        .where(F.col("matches") >= _least_matches(n, own, 0, t))
        .withColumn("level", F.when(few[0], 0).when(few[1], 1).otherwise(2))
        .withColumn("centrality", F.least(16 * F.col("others") / prefix, F.lit(1 << 30)).cast("int"))
        .select("key", "row_id", "n_shingles", "level", "centrality")
    )
    # Written, so that the lists' shuffle files are gone before texts are shuffled
    sharing = work.keep(sharing, "sharing")
    # Repeated rows share the row_id; counted twice, their shingles would make overlaps too large
    once_each = rows.join(sharing, "row_id").dropDuplicates(["row_id"])
    # Centrality and level in one number, so that the rows of shingles are narrow
    standing = (F.col("centrality").cast("long") * len(LEVELS) + F.col("level")).alias("standing")
    texts = work.keep(once_each.select("key", "n_shingles", standing, "text"), "texts")
    bare = texts.select("key", "text")
    level = (F.col("standing") % len(LEVELS)).cast("int")
    centrality = (F.col("standing") / len(LEVELS)).cast("long")
    sizes = texts.select("key", "n_shingles", "standing", level.alias("level"), _matches(n, level, t).alias("own"))
    sizes = work.keep(sizes.distinct(), "sizes")

    # Each text against the hubs of its shingles
    shown = texts.select("key", "standing", "text").mapInArrow(
        lambda b: _level_prefixes(b, size, t), "shingle long, key long, standing long"
    )
    levels = range(len(LEVELS))
    listed = shown.withColumn("hubs", _hubs(range(HUBS), centrality, by_shingle))
    for k in levels:
        at_level = level == k
        listed = listed.withColumn(f"n{k}", F.count_if(at_level).over(by_shingle) - at_level.cast("int"))
    listed = listed.where(sum((F.col(f"n{k}") for k in levels), F.lit(0)) > 0).drop("standing")
    listed = work.keep(listed, "listed")
    possible = F.lit(False)
    for k in levels:
        possible = possible | (F.col(f"m{k}") >= _least_matches(n, own, k, t))
    held = (
        listed.groupBy("key")
        .agg(*(F.count_if(F.col(f"n{k}") > 0).alias(f"m{k}") for k in levels))
        .join(sizes, "key")
        .where(possible)
        .select("key", "n_shingles", "level", "own", "standing")
    )
    held = work.keep(held, "held")
    pairs = work.keep(_with_hubs(listed, held, t), "hub-pairs")
    links = work.keep(_links(pairs, bare, size, t), "links")
    found = components(links, work, "first")

    # What may still link two components
    parts = work.keep(
        held.join(found.withColumnRenamed("node", "key"), "key", "left").withColumn(
            "component", F.coalesce("label", "key")
        ).drop("label"),
        "parts",
    )
    # A list's hub is the same for all its rows, so it need not be shuffled with them
    crossing = listed.select("shingle", "key").join(parts.select("key", "standing", "component"), "key")
    elsewhere = {"hub": F.get(_hubs(range(1), centrality, by_shingle), F.lit(0))}
    for k in levels:
        at_level = F.when(level == k, F.col("component"))
        low, high = F.min(at_level).over(by_shingle), F.max(at_level).over(by_shingle)
        elsewhere[f"e{k}"] = F.coalesce((low != F.col("component")) | (high != F.col("component")), F.lit(False))
    crossing = crossing.withColumns(elsewhere).where(" OR ".join(f"e{k}" for k in levels)).drop("component", "standing")
    crossing = work.keep(crossing, "crossing")
    work.drop("listed")
    left = (
        crossing.groupBy("key")
        .agg(*(F.count_if(f"e{k}").alias(f"m{k}") for k in levels))
        .join(parts, "key")
        .where(possible)
        .withColumn("most", F.array(*(F.col(f"m{k}") for k in levels)))
        .select("key", "n_shingles", "level", "own", "component", "most")
    )
    left = work.keep(left, "left")
    last = len(LEVELS) - 1
    whole = left.where(F.col("level") == last)
    around = _around_hubs(crossing.select("shingle", "key", "hub"), whole, t, work)
    more = work.keep(_block_links(around, bare, size, t), "links-around-hubs")

    # A pair with a prefix: its shingles are those of the texts that show prefixes
    lists = crossing.select("shingle", "key").join(left, "key")
    of_prefixes = lists.where(F.col("level") < last).select("shingle").distinct()
    lists = work.keep(lists.join(of_prefixes, "shingle"), "lists")
    x, y = lists.where(F.col("level") < last).alias("x"), lists.alias("y")
    most = F.least(F.get("x.most", F.col("y.level")), F.get("y.most", F.col("x.level")))
    needed = _pair_matches("x", "y", t)
    once = (F.col("x.key") < F.col("y.key")) | (F.col("y.level") == last)
    pairs = (
        x.join(y, F.col("x.shingle") == F.col("y.shingle"))
        .where(once & _sizes_allow("x", "y", t) & (F.col("x.component") != F.col("y.component")) & (most >= needed))
        .groupBy(F.col("x.key").alias("a"), F.col("y.key").alias("b"))
        .agg(F.count("*").alias("matches"), F.first(needed).alias("needed"))
        .where(F.col("matches") >= F.col("needed"))
        .select("a", "b", F.lit(False).alias("whole"))
    )
    pairs = work.keep(pairs, "pairs")
    work.drop("crossing", "lists")
    more = more.unionByName(work.keep(_links(pairs, bare, size, t), "links-of-prefixes"))
    merged = components(links.unionByName(more), work, "all")
    work.drop("texts")

    named = (
        distinct.join(merged.withColumnRenamed("node", "key"), "key", "left")
        .select("key", F.coalesce("label", "key").alias("label"), "doc_id")
    )
    ids = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    of_key = work.keep(named.join(ids, "label").select("key", "label", "component_id"), "components")
    component_id = F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return members.join(of_key, "key", "left").select(
        "doc_id", "row_id", "n_shingles", component_id.alias("component_id"), F.col("label").alias("component")
    )
