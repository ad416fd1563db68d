"""Secret scans in DataFrame functions: fixed patterns, and character Markov models for the rest."""

from __future__ import annotations

import math
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The patterns of the base kinds, in the order in which kinds are listed, and the least
# length that a match (for assign: of group 2) must have.
ASSIGN = (
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]{16,}"  # equal to AKIA[A-Z0-9]+ of 20 characters or more: shorter runs hold no longer one
HEX = r"[0-9a-f]{24,}"  # the maximal runs of 24 characters or more
ASSIGN_LEAST = 6
KINDS = ("assign", "access", "hex", "random")

#: Runs that the models judge, once the base spans are blanked out.
CANDIDATE_LEAST = 16
CANDIDATE = rf"[A-Za-z0-9+/_-]{{{CANDIDATE_LEAST},}}"
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_-"
#: Texts, in expectation, that the models are fitted on; drawn by a hash of the text.
SAMPLE_TEXTS = 2000
#: Counts that a transition's estimate borrows from the single characters.
PRIOR = 10.0
#: Log-likelihood ratio per transition from which a run counts as random, where no held-out samples set it.
PER_CHARACTER = 0.5
#: Share of held-out ordinary samples that lie below the limit.
QUANTILE = 0.999
#: Identifiers made of GENERAL, so that the ordinary class is wider than the texts at hand.
GENERAL_SAMPLES = 8000
# Everyday words of source code, paths and addresses.
GENERAL = (
    "account action address amount api app archive array async attempt audit backup balance base batch bin block body "
    "branch buffer build bundle button cache call category center channel character check child class cleanup client "
    "cluster code column com command comment commit common config connection content context controller copy core count "
    "create customer data database date debug default delete description detail device directory document domain download "
    "driver element email enable encoder engine entity error event example export extension factory feature field file "
    "filter final first folder format function gateway generate get global group handler hash header helper history home "
    "http image impl index info input instance integration interface internal item java job key label language last layer "
    "level library line link list listener load local location login main manager map master max member memory message "
    "method metric min mode model module monitor name network node notification number object offset operation option "
    "order org output package page parameter parent parse partition path payment platform plugin policy pool position "
    "process product profile project property provider public query queue random range read record reference region "
    "register release remote render report request reset resource response result retry role route row rule run sample "
    "schedule schema scope script search section select sequence server service session set setting shared size snapshot "
    "source spec split src stage start state static status step storage stream string style support sync system table tag "
    "target task template test text thread time title token tools total trace transaction transfer transform type update "
    "upload url user util valid value vendor version view web widget window worker workflow write www"
).split()
MASK = "[SECRET]"
_SCALE = 1 << 30
_SPAN = "array<struct<start:int,end:int,kind:int>>"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value computed once."""
    return F.transform(F.array(value), use)[0]


def _before(values: Column, op: Callable[[Column, Column], Column]) -> Column:
    """For each value, what ``op`` makes of 0 and all values before it.

    Values are taken in about sqrt(n) blocks of sqrt(n): arrays cannot be added to
    in place, so that one running pass would copy n * n / 2 values.
    """

    def running(part: Column, start: Column) -> Column:
        zero = F.struct(start.alias("at"), F.array().cast("array<int>").alias("out"))
        step = lambda s, x: F.struct(op(s["at"], x).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out"))
        return F.aggregate(part, zero, step, lambda s: s["out"])

    def blocked(v: Column) -> Column:
        width = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(v))).cast("int"))
        count = F.ceil(F.size(v) / width).cast("int")
        cut = F.transform(F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0))), lambda k: F.slice(v, k * width + 1, width))
        return _let(cut, offsets)

    def offsets(parts: Column) -> Column:
        starts = running(F.transform(parts, lambda x: F.aggregate(x, F.lit(0), op)), F.lit(0))
        return F.flatten(F.zip_with(parts, starts, running))

    return _let(values, blocked)


def _pieces(text: Column, pattern: str, least: int | None) -> Column:
    """(gap, match, good): what lies before each match, the match, and whether it counts; the last match is null."""
    p = F.lit(pattern)
    matches = F.regexp_extract_all(text, p, F.lit(0))
    values = matches if least is None else F.regexp_extract_all(text, p, F.lit(2))
    both = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), matches.alias("match"), values.alias("value"))
    enough = lambda x: F.coalesce(F.length(x["value"]) >= (least or 0), F.lit(False))
    return F.transform(both, lambda x: F.struct(x["gap"].alias("gap"), x["match"].alias("match"), enough(x).alias("good")))


def _spans(text: Column, pattern: str, kind: int, least: int | None = None) -> Column:
    """Spans of a pattern's matches, from left to right, in characters.

    The pieces between matches and the matches themselves, in turn, make up the
    text, so their lengths give the positions. ``least``: group 2 must have so
    many characters; the others are found, and drop out afterwards.
    """

    def placed(pieces: Column) -> Column:
        size = lambda x: F.length(x["gap"]) + F.coalesce(F.length(x["match"]), F.lit(0))
        starts = _before(F.transform(pieces, size), lambda a, b: a + b)

        def span(x: Column, at: Column) -> Column:
            start = at + F.length(x["gap"])
            end = start + F.length(x["match"])
            return F.when(
                x["good"], F.struct(start.alias("start"), end.alias("end"), F.lit(kind).alias("kind"))
            )

        return F.filter(F.zip_with(pieces, starts, span), lambda s: s.isNotNull()).cast(_SPAN)

    return _let(_pieces(text, pattern, least), placed)


def _blanked(text: Column, pattern: str, least: int | None = None) -> Column:
    """The text with a pattern's matches replaced by as many blanks."""

    def piece(x: Column) -> Column:
        match = F.coalesce(x["match"], F.lit(""))
        return F.concat(x["gap"], F.when(x["good"], F.repeat(F.lit(" "), F.length(match))).otherwise(match))

    return F.array_join(F.transform(_pieces(text, pattern, least), piece), "")


def _if(condition: Column, spans: Column) -> Column:
    return F.when(condition, spans).otherwise(F.array().cast(_SPAN))


def _named(text: Column) -> Column:
    low = F.lower(text)
    return low.contains("passw") | low.contains("secret") | low.contains("token") | low.contains("api")


def _base(text: Column) -> Column:
    """All base spans, by start, then kind."""
    found = F.concat(
        _if(_named(text), _spans(text, ASSIGN, 0, ASSIGN_LEAST)),
        _if(text.contains("AKIA"), _spans(text, ACCESS, 1)),
        _if(text.rlike(HEX), _spans(text, HEX, 2)),
    )
    return _by_start(found)


def _without_base(text: Column) -> Column:
    """The text with blanks where base spans lie; of two that overlap, the second is blanked as far as it still matches."""
    text = F.when(_named(text), _blanked(text, ASSIGN, ASSIGN_LEAST)).otherwise(text)
    return _let(text, lambda t: _blanked(_blanked(t, ACCESS), HEX))


def _by_start(spans: Column) -> Column:
    ordered = F.transform(spans, lambda s: F.struct(s["start"], s["kind"], s["end"]))
    return F.transform(
        F.array_sort(ordered), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))
    )


def _joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])), ",")


def _bigrams(samples: DataFrame) -> DataFrame:
    """(is_secret, place, n): counts of neighbouring characters; place is a cell of the transition matrix."""
    size = len(ALPHABET)
    pairs = samples.filter(F.length("sample") > 1).select(
        "is_secret", F.explode(F.expr("transform(sequence(1, length(sample) - 1), i -> substr(sample, i, 2))")).alias("pair")
    )
    a, b = F.instr(F.lit(ALPHABET), F.substring("pair", 1, 1)), F.instr(F.lit(ALPHABET), F.substring("pair", 2, 1))
    cells = pairs.select("is_secret", a.alias("a"), b.alias("b")).filter("a > 0 AND b > 0")
    return cells.groupBy("is_secret", ((F.col("a") - 1) * size + F.col("b")).alias("place")).agg(F.count(F.lit(1)).alias("n"))


class Model(NamedTuple):
    """Log-likelihood ratio of each transition, random against ordinary, and the limit per transition."""

    ratios: list[float]
    limit: float


def train(samples: DataFrame) -> Model:
    """The two classes' character models as one table of ratios, with a calibrated limit, from labelled samples.

    ``samples`` (sample, is_secret, held_out) hold random strings and ordinary
    identifiers. Each class is a first-order character Markov model over ALPHABET,
    counted from what is not held out; after a character, PRIOR counts are shared
    out as the class's single characters are, so that a character which names
    hardly use stays unlikely after any other. The limit is the QUANTILE of the
    ratio per transition of held-out ordinary samples of CANDIDATE_LEAST
    characters or more, but not negative; PER_CHARACTER without such samples. Null samples
    and classes without samples count nothing. There is one cell per pair of
    characters.
    """
    size = len(ALPHABET)
    counts = {k: [[0.0] * size for _ in range(size)] for k in (True, False)}
    known = samples.filter("sample IS NOT NULL AND is_secret IS NOT NULL")
    for r in _bigrams(known.filter("NOT held_out")).collect():  # at most 2 * size**2
        counts[r["is_secret"]][(r["place"] - 1) // size][(r["place"] - 1) % size] += r["n"]

    def chances(rows: list[list[float]]) -> list[float]:
        total = sum(map(sum, rows)) + size
        alone = [(sum(row[b] for row in rows) + 1) / total for b in range(size)]
        return [(n + PRIOR * p) / (sum(row) + PRIOR) for row in rows for n, p in zip(row, alone, strict=True)]

    ratios = [math.log(x) - math.log(y) for x, y in zip(chances(counts[True]), chances(counts[False]), strict=True)]
    held = known.filter("held_out AND NOT is_secret").filter(F.col("sample").rlike(f"^{CANDIDATE}$"))
    limit = held.agg(F.percentile(_score(F.col("sample"), ratios), F.lit(QUANTILE)).alias("limit")).first()["limit"]
    return Model(ratios, PER_CHARACTER if limit is None else max(limit, 0.0))


def _score(run: Column, ratios: list[float]) -> Column:
    """Mean ratio of a run's transitions; the run is of ALPHABET's characters, two or more."""
    size = len(ALPHABET)
    table = F.split(F.lit(",".join(f"{r:.6g}" for r in ratios)), ",").cast("array<double>")  # folded to one constant
    zero = F.struct(F.lit(0).alias("last"), F.lit(0.0).alias("sum"))

    def step(s: Column, character: Column) -> Column:
        place = F.instr(F.lit(ALPHABET), character)
        ratio = F.when(s["last"] > 0, F.element_at(table, (s["last"] - 1) * size + place)).otherwise(0.0)
        return F.struct(place.alias("last"), (s["sum"] + ratio).alias("sum"))

    return F.aggregate(F.split(run, "", -1), zero, step, lambda s: s["sum"]) / (F.length(run) - 1)


def _general(spark: SparkSession, n: int) -> DataFrame:
    """(sample, is_secret, held_out): ``n`` ordinary identifiers of GENERAL words, in common styles, some with numbers or dates.

    A fifth of the words stands in held-out samples only.
    """
    groups = [[w for i, w in enumerate(GENERAL) if (i % 5 == 0) == held] for held in (False, True)]
    draw = lambda k, of: F.pmod(F.xxhash64("id", F.lit(k)), F.lit(of))

    def word(k: int) -> Column:
        pick = [F.element_at(F.split(F.lit(" ".join(words)), " "), (draw(k, len(words)) + 1).cast("int")) for words in groups]
        return F.when(F.col("held_out"), pick[1]).otherwise(pick[0])

    words = F.slice(F.array(*[word(k) for k in range(6)]), 1, (3 + draw(10, 4)).cast("int"))

    def styled(words: Column) -> Column:
        joins = [F.array_join(words, by) for by in "_-/"]
        camel = F.array_join(F.transform(words, F.initcap), "")
        lower = F.concat(words[0], F.array_join(F.transform(F.slice(words, 2, 6), F.initcap), ""))
        return F.element_at(F.array(*joins, lower, F.upper(joins[0]), camel), (draw(11, 6) + 1).cast("int"))

    date = F.date_format(F.date_add(F.lit("2000-01-01").cast("date"), draw(12, 9000).cast("int")), "yyyy-MM-dd")
    ending = F.when(draw(13, 6) == 0, F.concat(F.lit("-"), date)).when(draw(13, 6) == 1, F.concat(F.lit("_v"), draw(14, 100)))
    rows = spark.range(n).withColumn("held_out", draw(15, 5) == 0)
    return rows.select(F.concat(_let(words, styled), F.coalesce(ending, F.lit(""))).alias("sample"), F.lit(False).alias("is_secret"), "held_out")


def labelled_samples(docs: DataFrame, texts: int = SAMPLE_TEXTS, text_col: str = "text") -> DataFrame:
    """(sample, is_secret, held_out) from a bounded sample of the texts, and general identifiers.

    Random: what the base patterns find, and digests of the texts in hexadecimal
    and base 64. Ordinary: the identifiers and words of five letters or more
    that stand in no match, and four such neighbours in one compound; and
    identifiers of GENERAL words. A fifth of the texts is held out.
    """
    key = F.xxhash64(text_col)
    rows = docs.filter(F.col(text_col).isNotNull()).select(F.col(text_col).alias("text"), key.alias("key"))
    n = rows.agg(F.approx_count_distinct("key").alias("n")).first()["n"]
    drawn = rows.filter(F.pmod("key", F.lit(_SCALE)) < int(min(1.0, texts / max(n, 1)) * _SCALE)).dropDuplicates(["key"])
    found = F.concat(
        F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2)),
        F.regexp_extract_all("text", F.lit(ACCESS), F.lit(0)),
        F.regexp_extract_all("text", F.lit(HEX), F.lit(0)),
    )
    coded = [F.base64(F.unhex(F.sha2(F.concat("text", F.lit(str(i))), 512))) for i in range(4)]
    digests = F.array(F.sha1("text"), F.upper(F.md5("text")), *coded)
    rest = F.regexp_replace(F.regexp_replace("text", ASSIGN, " "), f"{ACCESS}|{HEX}", " ")
    edge = "[A-Za-z0-9+/_-]"
    words = F.regexp_extract_all(rest, F.lit(rf"(?<!{edge})[A-Za-z_][A-Za-z_0-9]{{4,30}}(?!{edge})"), F.lit(0))
    held = (F.pmod(F.xxhash64("key"), F.lit(5)) == 0).alias("held_out")
    label = lambda samples, secret: drawn.select(F.explode(samples).alias("sample"), F.lit(secret).alias("is_secret"), held)
    ordinary = label(_let(words, lambda w: F.concat(w, _compounds(w))), False)
    return label(F.concat(found, digests), True).unionByName(ordinary).unionByName(_general(docs.sparkSession, GENERAL_SAMPLES))


def _compounds(words: Column) -> Column:
    """Every four words in a row as one identifier, in turn by underscores, hyphens, slashes and capitals."""

    def joined(k: Column) -> Column:
        four = F.slice(words, k * 4 + 1, 4)
        by = lambda c: F.array_join(four, c)
        style = k % 4
        camel = F.regexp_replace(F.initcap(by(" ")), " ", "")
        return F.when(style == 0, by("_")).when(style == 1, by("-")).when(style == 2, by("/")).otherwise(camel)

    last = (F.size(words) / 4).cast("int") - 1
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), joined)).otherwise(
        F.array().cast("array<string>")
    )


def _random(text: Column, model: Model) -> Column:
    """Spans of runs, and of what base spans leave of them, that the models take for random strings."""

    def judged(t: Column) -> Column:
        run = lambda r: F.substr(t, r["start"] + 1, r["end"] - r["start"])
        return F.filter(_spans(t, CANDIDATE, 3), lambda r: _score(run(r), model.ratios) > model.limit)

    return _let(_without_base(text), judged)


def scan(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, base, found) per row: base spans, and all spans, each by start, then kind.

    A span is (start, end, kind): code points, end exclusive, kind a place in
    KINDS. Base spans are the matches of the fixed patterns, leftmost and
    non-overlapping for each kind; ``random`` spans are added where no base span
    lies, beside one in the same run too. Null texts are empty and hold no span; whole texts are searched;
    repeated rows, null ids and empty tables stay; other columns are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col), text.alias("text")).withColumn("base", _base(F.col("text")))
    extra = _if(F.col("text").rlike(CANDIDATE), _random(F.col("text"), model))
    return rows.withColumn("found", _by_start(F.concat("base", extra)))


def redacted(text: Column, spans: Column) -> Column:
    """The text with every run of overlapping spans replaced by MASK; ``spans`` are in order of start."""

    def piece(s: Column, at: Column) -> Column:  # ``at``: where the spans before this one end
        gap = F.substr(text, at + 1, s["start"] - at)
        return F.when(s["start"] >= at, F.concat(gap, F.lit(MASK))).otherwise("")

    def masked(found: Column) -> Column:
        ends = F.transform(found, lambda s: s["end"])
        pieces = F.array_join(F.zip_with(found, _before(ends, lambda a, b: F.greatest(a, b)), piece), "")
        return F.concat(pieces, F.substr(text, F.array_max(ends) + 1, F.length(text)))

    return F.when(F.size(spans) > 0, _let(spans, masked)).otherwise(text)


def report(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts and digests of ``scan``'s result, one row each."""
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return scanned.select(
        id_col,
        *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS[:3])],
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.col("found")).alias("spans"),
    )


def without_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, lang, source, n_chars) with secrets masked; n_chars is that of the new text.

    Every row stays; a text without a span, and a null one, stays as it is, as do
    further columns, whatever their names.
    """
    model = train(labelled_samples(docs))
    text = F.coalesce("text", F.lit(""))
    found = max((c for c in docs.columns if c.startswith("found")), key=len, default="") + "found"  # not a column yet
    extra = _if(text.rlike(CANDIDATE), _random(text, model))
    rows = docs.withColumn(found, _by_start(F.concat(_base(text), extra)))
    masked = F.when(F.size(found) > 0, redacted(text, F.col(found))).otherwise(F.col("text"))
    rows = rows.withColumn("text", masked)
    changed = F.when(F.size(found) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return rows.withColumn("n_chars", changed).select(docs.columns)
