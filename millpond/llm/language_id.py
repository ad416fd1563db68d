"""Language identification by interpolated Kneser-Ney character models."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millpond.llm.arrowtext import BASE, mixed, slices

ORDER = 5
#: Distinct texts per language that the models are fitted on, in expectation (drawn by a hash of the text).
DOCS_PER_LANGUAGE = 400
#: Share of them, also by hash, kept back to calibrate scores and rejection.
CALIBRATION = 0.2
#: A text is rejected beyond this many times the calibration texts' quantile of standard scores.
MARGIN, QUANTILE = 1.5, 0.999
#: Calibration texts from which their quantile alone decides.
ENOUGH = 100
UNKNOWN = "und"
_LETTERS = re.compile(r"[^\W\d_]+")
_SCALE = 1 << 30


def normalised(text: str) -> str:
    """Lower-case letters, every run of anything else one blank; empty if there is no letter."""
    joined = " ".join(_LETTERS.findall(text.lower()))
    if joined and not joined.replace(" ", "").isalpha():  # numbers that are written as letters
        joined = " ".join("".join(c if c.isalpha() else " " for c in joined).split())
    return joined


def _padded(joined: str, order: int) -> str:
    return " " * (order - 1) + joined + " "


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)


def _gram_hashes(codes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n characters."""
    if len(codes) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(codes) - n + 1, np.uint64)
    for k in range(n):
        out *= np.uint64(BASE)
        out += codes[k : k + len(out)]
    return mixed(out)


@dataclass
class Table:
    """One order's n-grams of all languages: hashes in ascending order, and a row of values for each."""

    keys: np.ndarray
    logp: np.ndarray  # log probability of the last character after the others, per language
    gamma: np.ndarray  # log weight of the next lower order after this n-gram, per language

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Row of each hash, -1 where it is absent."""
        at = np.searchsorted(self.keys, hashes)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == hashes, at, -1)


@dataclass
class Model:
    languages: list[str]
    order: int
    tables: list[Table]  # by order, from 1
    floor: np.ndarray  # log probability of an unseen character, per language
    mean: np.ndarray  # of the cross-entropy of a language's own texts
    spread: np.ndarray  # variance of it between texts
    noise: np.ndarray  # variance of one character's log probability
    limit: float = np.inf  # largest standard score that is still accepted
    calibrated: int = 0  # texts it was found on
    sharpness: float = 1.0  # of the scores

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per character of normalised, non-empty texts under each language, and their lengths."""
        padded = [_padded(t, self.order) for t in texts]
        sizes = np.array([len(p) for p in padded])
        codes = _codes("".join(padded))
        values = self._values(codes)
        # the first order-1 blanks of a text are context only
        ends = np.cumsum(sizes)
        starts = ends - sizes + self.order - 1
        counts = sizes - self.order + 1
        cuts = np.stack((starts, ends), 1).ravel()[:-1] - (self.order - 1)
        sums = np.stack([np.add.reduceat(values[:, i], cuts, dtype=np.float64)[::2] for i in range(values.shape[1])], 1)
        return -sums / counts[:, None], counts

    def _values(self, codes: np.ndarray) -> np.ndarray:
        """Log probability of each character from position order-1 on, per language."""
        found = self.tables[-1].find(_gram_hashes(codes, self.order))
        out = self.tables[-1].logp[found]
        left = np.flatnonzero(found < 0)
        out[left] = 0
        for n in range(self.order - 1, 0, -1):
            if not len(left):
                return out
            # windows of n characters: the context before the character, then the one that ends with it
            table = self.tables[n - 1]
            end = left + self.order - 1
            context = table.find(self._at(codes, end - n, n))
            seen = context >= 0
            out[left[seen]] += table.gamma[context[seen]]
            row = table.find(self._at(codes, end - n + 1, n))
            hit = row >= 0
            out[left[hit]] += table.logp[row[hit]]
            left = left[~hit]
        out[left] += self.floor
        return out

    @staticmethod
    def _at(codes: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
        out = np.zeros(len(starts), np.uint64)
        for k in range(n):
            out *= np.uint64(BASE)
            out += codes[starts + k]
        return mixed(out)

    def classify(self, texts: list[str]) -> list[tuple[str, float, float | None, bool]]:
        """(language, score, cross-entropy, rejected) of each text; ties go to the first language by name."""
        clean = [normalised(t) for t in texts]
        at = [i for i, t in enumerate(clean) if t]
        out: list[tuple[str, float, float | None, bool]] = [(UNKNOWN, 0.0, None, True)] * len(texts)
        if not at or not self.languages:
            return out
        entropy, counts = self.entropies([clean[i] for i in at])
        best = entropy.argmin(1)
        low = entropy[np.arange(len(at)), best]
        score = self._scores(entropy, counts)[np.arange(len(at)), best]
        odd = self._odd(low, counts, best)
        for i, b, s, h, r in zip(at, best, score, low, odd, strict=True):
            out[i] = (self.languages[b], float(s), float(h), bool(r))
        return out

    def _scores(self, entropy: np.ndarray, counts: np.ndarray) -> np.ndarray:
        gain = -(entropy - entropy.min(1, keepdims=True)) * np.sqrt(counts)[:, None] * self.sharpness
        share = np.exp(gain)
        return share / share.sum(1, keepdims=True)

    def _standard(self, low: np.ndarray, counts: np.ndarray, best: np.ndarray) -> np.ndarray:
        return (low - self.mean[best]) / np.sqrt(self.spread[best] + self.noise[best] / counts)

    def _odd(self, low: np.ndarray, counts: np.ndarray, best: np.ndarray) -> np.ndarray:
        """Further above the language's mean than calibration texts of known languages reach.

        Fewer than ``ENOUGH`` of them say too little of what is usual; then a text is rejected only if
        it is also no better than characters drawn evenly.
        """
        far = self._standard(low, counts, best) > self.limit
        return far if self.calibrated >= ENOUGH else far & (low > -self.even[best])

    @property
    def even(self) -> np.ndarray:
        """Log probability of a character drawn evenly from the characters a language has."""
        return -np.log(np.maximum(np.exp(self.tables[0].logp).astype(np.float64) > np.exp(self.floor) * 1.0001, 0).sum(0) + 1)


def _counts(labelled: DataFrame, order: int) -> dict[str, dict[str, int]]:
    """n-gram counts per language of a bounded sample, summed by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in slices(batches, "text"):
            found: dict[str, Counter] = defaultdict(Counter)
            for lang, text in zip(rows.column("lang").to_pylist(), texts.to_pylist(), strict=True):
                joined = normalised(text)
                if joined:
                    line = _padded(joined, order)
                    found[lang].update(line[i : i + order] for i in range(len(line) - order + 1))
            flat = [(lang, g, n) for lang, grams in found.items() for g, n in grams.items()]
            yield pa.record_batch(
                [
                    pa.array([f[0] for f in flat], pa.string()),
                    pa.array([f[1] for f in flat], pa.string()),
                    pa.array([f[2] for f in flat], pa.int64()),
                ],
                ["lang", "gram", "n"],
            )

    grams = labelled.select("lang", "text").mapInArrow(run, "lang string, gram string, n long")
    table = grams.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    out: dict[str, dict[str, int]] = defaultdict(dict)
    for lang, gram, n in zip(*(table.column(c).to_pylist() for c in ("lang", "gram", "n")), strict=True):
        out[lang][gram] = n
    return out


class _KneserNey:
    """Interpolated probabilities of one language."""

    def __init__(self, grams: dict[str, int], order: int):
        self.counts: list[dict[str, int]] = [{} for _ in range(order + 1)]
        self.counts[order] = grams
        for n in range(order - 1, 0, -1):  # below the top, the number of different characters in front
            self.counts[n] = Counter(g[1:] for g in self.counts[n + 1])
        self.total: list[Counter] = [Counter() for _ in range(order + 1)]
        self.kinds: list[Counter] = [Counter() for _ in range(order + 1)]
        self.discount = [0.0] * (order + 1)
        for n in range(1, order + 1):
            for gram, c in self.counts[n].items():
                self.total[n][gram[:-1]] += c
                self.kinds[n][gram[:-1]] += 1
            of = Counter(self.counts[n].values())
            self.discount[n] = of[1] / (of[1] + 2 * of[2]) if of[1] else 0.5
        self.floor = 1.0 / (len(self.counts[1]) + 1)  # one more for unseen characters

    def weight(self, n: int, context: str) -> float:
        """Share that order n passes on to the next lower one after a context."""
        total = self.total[n].get(context)
        return self.discount[n] * self.kinds[n][context] / total if total else 1.0

    def value(self, gram: str, lower: float) -> float:
        n = len(gram)
        total = self.total[n].get(gram[:-1])
        own = max(self.counts[n].get(gram, 0) - self.discount[n], 0) / total if total else 0.0
        return own + self.weight(n, gram[:-1]) * lower


def _tables(counts: dict[str, dict[str, int]], order: int) -> tuple[list[str], list[Table], np.ndarray]:
    languages = sorted(counts)
    models = [_KneserNey(counts[x], order) for x in languages]
    floors = [m.floor * m.weight(1, "") for m in models]
    below: dict[str, list[float]] = {"": [m.floor for m in models]}
    tables = []
    for n in range(1, order + 1):
        grams = {g for m in models for g in m.counts[n]}
        if n < order:
            grams |= {g for m in models for g in m.total[n + 1]}
        names = sorted(grams)
        values = {g: [m.value(g, low) for m, low in zip(models, below[g[1:]], strict=True)] for g in names}
        gammas = [[m.weight(n + 1, g) if n < order else 1.0 for m in models] for g in names]
        keys = _gram_hashes(_codes("".join(names)), n)[::n] if names else np.zeros(0, np.uint64)
        place = np.argsort(keys)
        logp = np.log(np.array([values[g] for g in names])).astype(np.float32)
        tables.append(Table(keys[place], logp[place], np.log(np.array(gammas)).astype(np.float32)[place]))
        below = values
    return languages, tables, np.log(np.array(floors)).astype(np.float32)


def sample(labelled: DataFrame, docs_per_language: int) -> DataFrame:
    """(lang, text, part): distinct texts per language, drawn by a hash of the text; part is even in [0, 1)."""
    key = F.xxhash64("text")
    rows = labelled.filter("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text", key.alias("key"))
    sizes = rows.groupBy("lang").agg(F.approx_count_distinct("key").alias("n"))
    shares = {r["lang"]: min(1.0, docs_per_language / max(r["n"], 1)) for r in sizes.collect()}
    if not shares:
        return rows.select("lang", "text", F.lit(0.0).alias("part"))
    chosen = F.lit(False)
    for lang, share in sorted(shares.items()):
        chosen |= (F.col("lang") == lang) & (F.pmod("key", F.lit(_SCALE)) < int(share * _SCALE))
    drawn = rows.filter(chosen).dropDuplicates(["lang", "key"])
    return drawn.select("lang", "text", (F.pmod(F.xxhash64("key"), F.lit(_SCALE)) / _SCALE).alias("part"))


def train(
    labelled: DataFrame, order: int = ORDER, docs_per_language: int = DOCS_PER_LANGUAGE
) -> Model:
    """Models of the languages in ``labelled`` (text, lang), fitted on a bounded sample of it.

    Scores and rejection are calibrated on a part of the sample that the models
    do not see. Rows without language or text teach nothing; a language whose
    texts hold no letter is not learned.
    """
    drawn = sample(labelled, docs_per_language)
    counts = _counts(drawn.filter(F.col("part") >= CALIBRATION), order)
    languages, tables, floor = _tables(counts, order) if counts else ([], [], np.zeros(0, np.float32))
    size = len(languages)
    model = Model(languages, order, tables, floor, np.full(size, np.inf), np.ones(size), np.ones(size))
    if languages:
        kept = drawn.filter(F.col("part") < CALIBRATION).select("lang", "text").toArrow()
        _calibrate(model, kept.column("lang").to_pylist(), kept.column("text").to_pylist())
    return model


def _calibrate(model: Model, langs: list[str], texts: list[str]) -> None:
    """Mean and variances of each language's own texts; the limit no calibration text comes near; the sharpness."""
    pairs = [(model.languages.index(lang), t) for lang, text in zip(langs, texts, strict=True)
             if lang in model.languages and (t := normalised(text))]
    if not pairs:
        return
    own = np.array([p[0] for p in pairs])
    entropy, counts = model.entropies([p[1] for p in pairs])
    for i in range(len(model.languages)):
        mine = np.flatnonzero(own == i)
        if not len(mine):
            continue
        low, n = entropy[mine, i], counts[mine]
        long = n >= np.median(n)
        model.mean[i] = np.average(low, weights=n)
        model.spread[i] = max(np.var(low[long]), 1e-4)
        model.noise[i] = max(np.mean((low - model.mean[i]) ** 2 * n), 1.0)
    best = entropy.argmin(1)
    scores = model._standard(entropy[np.arange(len(own)), best], counts, best)
    model.calibrated = len(pairs)
    model.limit = MARGIN * float(np.quantile(scores[np.isfinite(scores)], QUANTILE)) if np.isfinite(scores).any() else np.inf
    losses = {}
    for sharpness in 2.0 ** np.arange(-4, 7):
        model.sharpness = float(sharpness)
        share = model._scores(entropy, counts)[np.arange(len(own)), own]
        losses[model.sharpness] = -np.log(np.clip(share, 1e-6, 1)).mean()
    model.sharpness = min(losses, key=lambda k: (round(losses[k], 6), k))


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, cross_entropy, rejected) per row, from the text alone.

    Null texts and texts without a letter are ``und`` with score 0 and are
    rejected; so is every text if no language was learned. Whole texts are
    scored; repeated rows, null ids and empty tables stay; ties go to the first
    language by name; other columns are not read.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in slices(batches, text_col):
            out = shipped.value.classify(texts.to_pylist())
            columns = [pa.array([o[k] for o in out], t) for k, t in enumerate((pa.string(), pa.float64(), pa.float64(), pa.bool_()))]
            yield pa.record_batch([rows.column(id_col), *columns], ["id", "lang_pred", "score", "cross_entropy", "rejected"])

    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(id_col, text_col).mapInArrow(
        run, f"id {kind}, lang_pred string, score double, cross_entropy double, rejected boolean"
    )
    return out.withColumnRenamed("id", id_col)


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` (with a column text) that are not rejected, with their columns; no join by id."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in slices(batches, "text"):
            out = shipped.value.classify(texts.to_pylist())
            yield rows.filter(pa.array([not o[3] for o in out], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
