"""Language identification by Bayesian fusion of evidence.

Three kinds of evidence are combined in log space:

* the text: likelihoods of its letter pairs under each language, from counts over all labelled texts;
* the declared language (of the markup, or a column): how often texts of a language declare what they do;
* where it is from: a prior that is smoothed level by level, host towards domain, domain towards address
  suffix, suffix towards all. The suffix is a level of this prior and not counted a second time. A row's own
  posterior is taken out of the sums of every level before they become its prior, so its text counts once.

All tables behind it are grouped aggregations over all rows: pair counts by language (at most 65,536 for each),
declarations by language, and sums of the text-only posteriors by host, domain and suffix, which are
joined back by key, never collected. The languages are all those that label a text; more than MOST_LANGUAGES
end the job with an error.

A text without letters has no text evidence; where nothing else speaks, the prior decides. `n_pairs` is the
amount of text evidence. Null and empty texts have none; null hosts share one host; declarations that are
null or no known language are no evidence. Repeated rows are judged alike; each counts in the sums. Equal
probabilities go to the language that sorts first. Texts of any length are read whole, markup in one pass. An
empty table gives no rows; without any labelled text every row is of the one language `und`, undetermined. Columns
other than the named ones are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.text_arrays import words_of
from tallyhouse.llm.warc import html_language, page_text
from tallyhouse.llm.work_tables import WorkTables

#: Languages of which the table of pairs, which every task holds, may be (256 KB for each).
MOST_LANGUAGES = 256
UNDETERMINED = "und"
PAIRS = 1 << 16
_CODE = re.compile(r"[A-Za-z]{2,3}")
#: Labels below a two-letter suffix under which names are registered, as in co.uk.
_SECOND_LEVEL = ("ac", "co", "com", "edu", "gob", "gov", "net", "or", "org")

#: Bytes of letters: a-z after lower-casing, and all of characters beyond ASCII. Others read as a blank.
_LETTER = np.full(256, 0x20, dtype=np.uint8)
_LETTER[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_LETTER[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
_LETTER[0x80:] = np.arange(0x80, 0x100)
_BLANKS = 0x20 << 8 | 0x20


def _pairs(words) -> tuple[np.ndarray, np.ndarray]:
    """Letter pairs of a chunk's texts, and where each text's begin. Pairs over two texts are left out."""
    texts = words.rows.column("text")
    sizes = np.array([len(t.as_buffer()) if t.is_valid else 0 for t in texts])
    begin = np.append(0, np.cumsum(sizes))
    letters = _LETTER[words.data].astype(np.int32)
    codes = letters[:-1] << 8 | letters[1:]
    counts = codes != _BLANKS
    edges = begin[1:-1] - 1
    counts[edges[(edges >= 0) & (edges < len(counts))]] = False
    place = np.flatnonzero(counts)
    return codes[place], np.searchsorted(place, begin)


def declared_language(html: str) -> str | None:
    """Letters that begin the code in the markup, in lower case."""
    found = _CODE.match(html_language(html) or "")
    return found[0].lower() if found else None


def pair_counts(texts: DataFrame) -> DataFrame:
    """(lang, pair, n) over all rows of (lang, text) that have both."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for words in words_of(batches):
            codes, first = _pairs(words)
            langs = words.rows.column("lang").to_pylist()
            names = sorted(set(langs))
            of = np.repeat([names.index(lang) for lang in langs], np.diff(first))
            found = np.bincount(of * PAIRS + codes, minlength=len(names) * PAIRS).reshape(-1, PAIRS)
            for name, counts in zip(names, found, strict=True):
                total[name] = total.get(name, 0) + counts
            if len(total) > MOST_LANGUAGES:
                raise ValueError(f"labelled texts have more than {MOST_LANGUAGES} languages")
        for name, counts in total.items():
            pair = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(pair), pa.string()), pa.array(pair, pa.int32()), pa.array(counts[pair], pa.int64())],
                names=["lang", "pair", "n"],
            )

    return (
        texts.select("lang", "text")
        .where((F.trim("lang") != "") & F.col("text").isNotNull())
        .mapInArrow(count, "lang string, pair int, n long")
        .groupBy("lang", "pair")
        .agg(F.sum("n").alias("n"))
    )


def likelihoods(counts: DataFrame) -> tuple[tuple[str, ...], np.ndarray]:
    """The languages that label a text, and the log probability of each pair for each of them (pairs x languages),
    unseen ones as half a time seen. There is a row for each language and pair, so collecting them is bounded."""
    rows = counts.collect()
    languages = tuple(sorted({row["lang"] for row in rows})) or (UNDETERMINED,)
    if len(languages) > MOST_LANGUAGES:
        raise ValueError(f"labelled texts have more than {MOST_LANGUAGES} languages")
    place = {language: i for i, language in enumerate(languages)}
    table = np.full((PAIRS, len(languages)), 0.5)
    for row in rows:
        table[row["pair"], place[row["lang"]]] += row["n"]
    return languages, np.log(table / table.sum(axis=0)).astype(np.float32)


def host_levels(host: Column) -> tuple[Column, Column]:
    """Registered domain (the last two labels, three below suffixes like co.uk) and suffix (the last label) of a
    host without port."""
    labels = F.split(F.regexp_replace(host, ":[0-9]+$", ""), r"\.")
    second = F.get(labels, F.size(labels) - 2).isin(*_SECOND_LEVEL) & (F.length(F.element_at(labels, -1)) == 2)
    first = F.greatest(F.size(labels) - F.when(second, 2).otherwise(1), F.lit(1))
    return F.array_join(F.slice(labels, first, F.size(labels)), "."), F.element_at(labels, -1)


def _lists(rows: np.ndarray, missing: np.ndarray | None = None) -> pa.ListArray:
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    mask = None if missing is None else pa.array(missing)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.reshape(-1)), mask=mask)


def _normalized(logs: np.ndarray) -> np.ndarray:
    """Probabilities from log weights, row by row."""
    weights = np.exp(logs - logs.max(axis=1, keepdims=True, initial=-np.inf))
    return weights / weights.sum(axis=1, keepdims=True)


def text_evidence(rows: DataFrame, table: np.ndarray, text_weight: float, *, markup: bool) -> DataFrame:
    """row_id, host, declared, n_pairs, log_text (one number for each language) and by_text (the posterior by the
    text alone, null without pairs) of (row_id, text, host, declared). markup: text is HTML, which declares its
    language."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            declared = batch.column("declared")
            if markup:
                pages = [t or "" for t in batch.column("text").to_pylist()]
                declared = pa.array(map(declared_language, pages), pa.string())
                text = pa.array([page_text(p) for p in pages], pa.large_string())
                batch = batch.set_column(batch.schema.get_field_index("text"), "text", text)
            at = 0
            for words in words_of(iter([batch])):
                codes, first = _pairs(words)
                rows, n = words.rows, np.diff(first)
                sums = np.zeros((len(n), table.shape[1]))
                for i in np.flatnonzero(n):
                    sums[i] = table[codes[first[i] : first[i + 1]]].sum(axis=0, dtype=np.float64)
                logs = text_weight * sums
                yield pa.RecordBatch.from_arrays(
                    [rows.column("row_id"), rows.column("host"), declared.slice(at, len(n)),
                     pa.array(n, pa.int64()), _lists(logs), _lists(_normalized(logs), n == 0)],
                    names=["row_id", "host", "declared", "n_pairs", "log_text", "by_text"],
                )
                at += len(n)

    return rows.select("row_id", "text", "host", "declared").mapInArrow(
        score, "row_id long, host string, declared string, n_pairs long, log_text array<double>, by_text array<double>"
    )


def _fused(languages: tuple[str, ...], everywhere: np.ndarray, spoken: np.ndarray, smoothing: float):
    """The evidence of each row put together; spoken: log probability of a declaration (language x declared)."""
    k, place = len(languages), {language: i for i, language in enumerate(languages)}

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:

            def matrix(name: str) -> np.ndarray:
                return batch.column(name).flatten().to_numpy().reshape(-1, k)

            by_text = batch.column("by_text")
            seen = by_text.is_valid().to_numpy(zero_copy_only=False)
            own = np.zeros((batch.num_rows, k))
            own[seen] = matrix("by_text")
            prior = np.full((batch.num_rows, k), 1 / k)
            for sums in (everywhere, matrix("of_suffix"), matrix("of_domain"), matrix("of_host")):
                # Shares of the other rows of a level, drawn towards those of the level above
                others = np.maximum(sums - own, 0)
                prior = (others + smoothing * prior) / (others.sum(axis=1, keepdims=True) + smoothing)
            fused = matrix("log_text") + np.log(prior)
            declared = np.array([place.get(d, -1) for d in batch.column("declared").to_pylist()], dtype=np.int64)
            fused[declared >= 0] += spoken[:, declared[declared >= 0]].T
            posterior = _normalized(fused)
            names = np.array(languages, dtype=object)
            columns = [batch.column(name) for name in ("row_id", "host", "declared", "n_pairs", "log_text")]
            columns += [
                _lists(posterior),
                pa.array(names[posterior.argmax(axis=1)], pa.string()),
                pa.array(posterior.max(axis=1)),
                pa.array(names[own.argmax(axis=1)], pa.string(), mask=~seen),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _FUSED.split(", ")])

    return combine


_FUSED = (
    "row_id long, host string, declared string, n_pairs long, log_text array<double>, posterior array<double>, "
    "language string, probability double, text_language string"
)


def fuse(
    evidence: DataFrame, work: WorkTables, *, languages: tuple[str, ...], smoothing: float = 20.0
) -> DataFrame:
    """evidence with language, probability, text_language and posterior (one number for each language)."""
    k = len(languages)
    seen = evidence.withColumn("host", F.coalesce(F.lower("host"), F.lit("")))
    domain, suffix = host_levels(F.col("host"))
    seen = seen.withColumn("domain", domain).withColumn("suffix", suffix)

    def sums(*keys: str) -> DataFrame:
        each = [F.coalesce(F.sum(F.get("by_text", F.lit(i))), F.lit(0.0)) for i in range(k)]
        return seen.groupBy(*keys).agg(F.array(*each).alias("sums"))

    hosts = work.keep(sums("host", "domain", "suffix"), "hosts")

    def level(*keys: str, name: str) -> DataFrame:
        each = [F.sum(F.get("sums", F.lit(i))) for i in range(k)]
        return hosts.groupBy(*keys).agg(F.array(*each).alias(name))

    everywhere = level(name="all").first()["all"]
    domains = level("domain", "suffix", name="of_domain").join(level("suffix", name="of_suffix"), "suffix")
    levels = hosts.join(domains.drop("suffix"), "domain").select(
        "host", F.col("sums").alias("of_host"), "of_domain", "of_suffix"
    )
    # How texts of each language declare theirs: languages x languages numbers
    declarations = np.full((k, k), 0.5)
    each = [F.sum(F.get("by_text", F.lit(i))).alias(f"n{i}") for i in range(k)]
    for row in seen.where(F.col("declared").isin(*languages)).groupBy("declared").agg(*each).collect():
        declarations[:, languages.index(row["declared"])] += [row[f"n{i}"] or 0.0 for i in range(k)]
    spoken = np.log(declarations / declarations.sum(axis=1, keepdims=True))
    rows = seen.join(levels, "host").select(
        "row_id", "host", "declared", "n_pairs", "log_text", "by_text", "of_host", "of_domain", "of_suffix"
    )
    overall = np.array([x or 0.0 for x in everywhere])
    return rows.mapInArrow(_fused(languages, overall, spoken, smoothing), _FUSED)


def identify(
    rows: DataFrame, labelled: DataFrame, *, markup: bool, text_weight: float = 0.2, smoothing: float = 20.0
) -> DataFrame:
    """Language of every row of (row_id, text, host, declared), text likelihoods fitted to all rows of
    labelled (lang, text). text_weight tempers the pairs, which are not independent."""
    work = WorkTables(rows.sparkSession, "language-id")
    languages, table = likelihoods(pair_counts(labelled))
    evidence = work.keep(text_evidence(rows, table, text_weight, markup=markup), "evidence")
    return fuse(evidence, work, languages=languages, smoothing=smoothing)
