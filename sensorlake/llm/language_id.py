"""Language identification of web pages by Bayesian evidence fusion.

Evidence of a page: the likelihood of its visible text under byte-trigram models trained on the
documents of each language; the language its markup declares; the suffix of its address; and a
prior of its host. How far a declared language or a suffix tells the true one is estimated from all
pages, as expected counts under the posterior of the text alone. The host prior is smoothed down a
hierarchy: all pages, the last two labels of the host, the last three, the host itself, each level's
counts added to ``STRENGTH`` pseudo-pages of the level above. A page's own share is taken out of
every count it is judged by. The logs of all factors are summed.

Scale: trigram counts are summed per task before they are shuffled, and their table has at most
languages x ``SLOTS`` rows; counts by host, declared language and suffix are grouped aggregations
with map-side combine, joined back to narrow rows, so a host with a third of all pages is one row
a task.

The text counts by blocks (lines; every tag ends one). A block may be foreign, an advertisement or
a quotation, with probability ``FOREIGN``, which bounds what a single block can say; within a block
trigrams are not independent and count as ``EFFECTIVE`` of them at most.

Defined cases: null or empty html has no text evidence, a null address an empty host, and a missing
declaration is a value of its own; training documents without a language are not used; without any
the result's language is null with confidence 0; ties go to the first language in order; repeated
rows are judged alike; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T
from .common import stored

SLOTS = 1 << 14
EFFECTIVE = 100
#: Chance that a block is in any language, whatever the page's.
FOREIGN = 0.05
STRENGTH = 10.0
ALPHA = 1.0
#: Not text of the page itself: comments, tags, and what stands inside these tags.
_TAG = re.compile(r"(?is)<!--.*?(?:-->|\Z)|<(script|style|nav|header|footer|aside)\b[^>]*>|<[^>]*>")
_CLOSING = re.compile(r"(?i)</(script|style|nav|header|footer|aside)\s*>")
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LEVELS = ("two", "three", "host")


def visible(page: str | None) -> str:
    """The text of a page. A hidden element ends with its next closing tag; of one that is never
    closed only the tag itself is left out."""
    page, out, at = page or "", [], 0
    closings: dict[str, list[tuple[int, int]]] = {}
    for m in _CLOSING.finditer(page):
        closings.setdefault(m[1].lower(), []).append(m.span())
    while m := _TAG.search(page, at):
        out.append(page[at:m.start()])
        at = m.end()
        if m[1]:
            ends = closings.get(m[1].lower(), [])
            if (i := bisect_left(ends, (at, at))) < len(ends):
                at = ends[i][1]
    return entities.unescape("\n".join([*out, page[at:]]))


def trigram_slots(buf: np.ndarray) -> np.ndarray:
    """Slot of the byte trigram at every place but the last two."""
    x = _LOWER[buf].astype(np.uint32)
    if len(x) < 3:
        return np.zeros(0, np.int64)
    return (((x[:-2] << 16 | x[1:-1] << 8 | x[2:]) * np.uint32(2654435761)) >> np.uint32(18)
            ).astype(np.int64)


@dataclass
class Model:
    languages: list[str]
    logs: np.ndarray    # languages x SLOTS log-probabilities
    prior: np.ndarray   # log shares of the languages' documents

    def scores(self, column: pa.Array) -> np.ndarray:
        """Log-likelihood of each text in each language, from its lines as blocks."""
        out, k = [np.zeros((0, len(self.languages)))], max(len(self.languages), 1)
        for i, j, buf, off in T.texts(column):
            slots = trigram_slots(buf)
            starts, ends = T.line_spans(buf)
            ends = np.minimum(np.maximum(ends - 2, starts), len(slots))
            starts = np.minimum(starts, len(slots))
            n = ends - starts
            sums = np.zeros((len(n), len(self.languages)))
            for lang in range(len(self.languages)):
                total = np.r_[0.0, np.cumsum(self.logs[lang][slots])]
                sums[:, lang] = total[ends] - total[starts]
            sums *= np.minimum(1.0, EFFECTIVE / np.maximum(n, 1))[:, None]
            block = np.log((1 - FOREIGN) * softmax(sums) + FOREIGN / k)
            block -= block.mean(1, keepdims=True) if len(self.languages) else 0.0
            block[n == 0] = 0.0
            total = np.r_[np.zeros((1, block.shape[1])), np.cumsum(block, 0)]
            lines = np.searchsorted(T.line_spans(buf)[0], off)
            out.append(total[lines[1:]] - total[lines[:-1]])
        return np.concatenate(out)


def softmax(x: np.ndarray) -> np.ndarray:
    if not x.size:
        return x
    x = np.exp(x - x.max(1, keepdims=True))
    return x / x.sum(1, keepdims=True)


def train(docs: DataFrame, text: str = "text", language: str = "lang") -> Model:
    """Trigram models from all documents that have a language."""
    rows = docs.select(F.col(language).alias("l"), F.col(text).alias("t")).where("l IS NOT NULL")

    def run(batches: Iterator[pa.RecordBatch]):
        counts, texts = {}, {}
        for b in batches:
            names = np.array(b.column(0).to_pylist(), dtype=object)
            for i, j, buf, off in T.texts(b.column(1)):
                slots = trigram_slots(buf)
                whole = (buf != 0x0A)
                whole = whole[:-2] & whole[1:-1] & whole[2:] if len(slots) else whole[:0]
                doc = np.repeat(np.arange(j - i), np.diff(off))[:len(slots)]
                for name in dict.fromkeys(names[i:j]):
                    own = names[i:j] == name
                    counts.setdefault(name, np.zeros(SLOTS, np.int64))
                    counts[name] += np.bincount(slots[whole & own[doc]], minlength=SLOTS)
                    texts[name] = texts.get(name, 0) + int(own.sum())
        for name, c in counts.items():
            used = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * (len(used) + 1), pa.string()), pa.array(np.r_[-1, used]),
                 pa.array(np.r_[texts[name], c[used]])], names=["l", "slot", "n"])

    found = rows.mapInArrow(run, "l string, slot long, n long").groupBy("l", "slot").agg(
        F.sum("n").alias("n")).toArrow().to_pandas()
    languages = sorted(found["l"].unique())
    counts = np.zeros((len(languages), SLOTS))
    share = np.zeros(len(languages))
    of = found["l"].map({x: i for i, x in enumerate(languages)}).to_numpy(np.int64)
    slot, n = found["slot"].to_numpy(np.int64), found["n"].to_numpy(float)
    share[of[slot < 0]] = n[slot < 0]
    counts[of[slot >= 0], slot[slot >= 0]] = n[slot >= 0]
    logs = np.log((counts + 0.5) / (counts.sum(1, keepdims=True) + 0.5 * SLOTS))
    return Model(languages, logs, np.log((share + 1) / (share.sum() + max(len(languages), 1))))


def _lists(values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(
        np.arange(len(values) + 1, dtype=np.int32) * values.shape[1],
        pa.array(np.ascontiguousarray(values, float).ravel()))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, width)


def text_evidence(pages: DataFrame, model: Model, key: str, html: str) -> DataFrame:
    """Adds ``p``, the posterior of the text alone, and ``score``, its log-likelihoods; drops the
    html. ``pages`` has the columns host, declared and suffix."""
    held = pages.sparkSession.sparkContext.broadcast(model)  # languages x SLOTS floats
    kind = pages.schema[key].dataType.simpleString()
    kept = [key, "host", "declared", "suffix"]

    def run(batches: Iterator[pa.RecordBatch]):
        m = held.value
        for b in batches:
            seen = pa.array([visible(v.as_py()) for v in b.column(len(kept))], pa.large_string())
            score = m.scores(seen)
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:len(kept)], _lists(softmax(score + m.prior)), _lists(score)],
                names=[*kept, "p", "score"])

    return pages.select(*kept, html).mapInArrow(
        run, f"`{key}` {kind}, host string, declared string, suffix string, p array<double>, "
             "score array<double>")


def identify(pages: DataFrame, model: Model, key: str = "page_id", url: str = "url",
             html: str = "html") -> DataFrame:
    """``key, lang, confidence, text_lang, declared`` of every page."""
    k = len(model.languages)
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")),
                                    r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/:?#]*)", 1))
    declared = F.lower(F.regexp_extract(F.coalesce(html, F.lit("")),
                                        r"(?i)<html[^>]*\slang\s*=\s*[\"']?([a-z]{2,3})", 1))
    nothing = F.lit(None).cast("string")
    if not k:
        return pages.select(key, nothing.alias("lang"), F.lit(0.0).alias("confidence"),
                            nothing.alias("text_lang"), declared.alias("declared"))
    rows = pages.select(F.col(key), F.col(html), host.alias("host"), declared.alias("declared"))
    rows = rows.withColumn("suffix", F.substring_index("host", ".", -1))
    rows = stored(text_evidence(rows, model, key, html), "lang-evidence")
    rows = rows.withColumns({"two": F.substring_index("host", ".", -2),
                             "three": F.substring_index("host", ".", -3)})
    sums = F.array(*(F.sum(F.col("p")[i]) for i in range(k)))
    total = rows.agg(sums.alias("s")).first()["s"]
    total = np.array(total if total and total[0] is not None else [0.0] * k, float)
    joined, values = rows, {}
    for c in ("declared", "suffix", *_LEVELS):
        counts = stored(rows.groupBy(c).agg(sums.alias(f"n_{c}")), f"lang-{c}")
        if c in ("declared", "suffix"):
            values[c] = counts.count()
        joined = joined.join(counts, c)
    names = [f"n_{c}" for c in ("declared", "suffix", *_LEVELS)]
    languages = model.languages
    kind = pages.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            p, score = (_matrix(b.column(c), k) for c in ("p", "score"))
            n = {c: np.maximum(_matrix(b.column(c), k) - p, 0) for c in names}
            others = np.maximum(total - p, 0)
            log = score.copy()
            for c in ("declared", "suffix"):
                log += np.log((n[f"n_{c}"] + ALPHA) / (others + ALPHA * values[c]))
            prior = (others + 1) / (others + 1).sum(1, keepdims=True)
            for c in _LEVELS:
                own = n[f"n_{c}"]
                prior = (own + STRENGTH * prior) / (own.sum(1, keepdims=True) + STRENGTH)
            post = softmax(log + np.log(prior))
            name = pa.array([languages[i] for i in post.argmax(1)], pa.string())
            told = pa.array([languages[i] for i in p.argmax(1)], pa.string())
            yield pa.RecordBatch.from_arrays(
                [b.column(key), name, pa.array(post.max(1)), told, b.column("declared")],
                names=[key, "lang", "confidence", "text_lang", "declared"])

    return joined.select(key, "declared", "p", "score", *names).mapInArrow(
        run, f"`{key}` {kind}, lang string, confidence double, text_lang string, declared string")
