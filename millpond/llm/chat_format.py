"""Chat transcripts: roles recovered by a hidden Markov model over lines, then a canonical rendering."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millpond.llm.arrowtext import slices

ROLES = ("system", "user", "assistant")
#: States: the first line of a turn, and a further line of it, for each role.
STATES = tuple((role, first) for role in ROLES for first in (True, False))
#: Names that transcripts use for each role, in lower case.
NAMES = {
    "system": ("system", "instructions", "context"),
    "user": ("user", "human", "question", "q", "customer", "prompt", "instruction"),
    "assistant": ("assistant", "ai", "bot", "answer", "a", "agent", "response", "model"),
}
_ROLE_OF = {name: role for role, names in NAMES.items() for name in names}
_MARKER = re.compile(
    r"\s*(?:<\|(?P<tag>[A-Za-z]+)\|>|#{1,4}\s*(?P<head>[A-Za-z]+)\s*:?\s*$|[*\[(]{0,2}(?P<name>[A-Za-z]+)[*\])]{0,2}\s*:(?=\s|$))\s*"
)
#: Conversations, in expectation, that the model is fitted on; drawn by a hash of the id.
SAMPLE = 2000
_SCALE = 1 << 30


def marker(line: str) -> tuple[str | None, str]:
    """The role that a line's speaker marker names (None without a known one), and the rest of the line."""
    found = _MARKER.match(line)
    if found:
        role = _ROLE_OF.get((found["tag"] or found["head"] or found["name"]).lower())
        if role:
            return role, line[found.end() :]
    return None, line


def features(line: str) -> tuple[int, int, int, int]:
    """Role named by a marker (0: none), blank line, question mark at the end, length class."""
    role, rest = marker(line)
    size = len(rest)
    named = 1 + ROLES.index(role) if role else 0
    return named, int(not rest.strip()), int(rest.rstrip().endswith("?")), 0 if size < 40 else 1 if size < 200 else 2


_SIZES = (4, 2, 2, 3)


@dataclass
class Hmm:
    """Log probabilities: first states, transitions, and each feature's values by state."""

    start: list[float]
    step: list[list[float]]
    emit: list[list[list[float]]]  # feature, state, value

    def viterbi(self, lines: list[tuple[int, int, int, int]]) -> list[int]:
        """The most likely states; among equals those of the smallest numbers from the end on."""
        n = len(STATES)
        score: list[float] = []
        back: list[list[int]] = []
        for i, line in enumerate(lines):
            seen = [sum(self.emit[f][s][v] for f, v in enumerate(line)) for s in range(n)]
            if i == 0:
                score = [self.start[s] + seen[s] for s in range(n)]
                continue
            best = [max(range(n), key=lambda r: (score[r] + self.step[r][s], -r)) for s in range(n)]
            score = [score[best[s]] + self.step[best[s]][s] + seen[s] for s in range(n)]
            back.append(best)
        if not lines:
            return []
        path = [max(range(n), key=lambda s: (score[s], -s))]
        for best in reversed(back):
            path.append(best[path[-1]])
        return path[::-1]


def turns(model: Hmm, text: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a transcript; markers are taken off, and blank lines around a turn."""
    lines = text.splitlines()
    states = model.viterbi([features(x) for x in lines])
    out: list[tuple[str, list[str]]] = []
    for line, state in zip(lines, states, strict=True):
        role, first = STATES[state]
        named, rest = marker(line)
        if first or not out or out[-1][0] != role:
            out.append((role, [rest if named == role else line]))
        else:
            out[-1][1].append(line)
    joined = [(role, "\n".join(part).strip()) for role, part in out]
    return [x for x in joined if x[1]]


def render(parts: list[tuple[str, str]]) -> str:
    """The canonical form: each turn after a tag with its role, and an end tag."""
    return "".join(f"<|{role}|>\n{text}\n<|end|>\n" for role, text in parts)


def transcripts(turns_: DataFrame) -> DataFrame:
    """(conv_id, text): one transcript per conversation of ``turns_`` (conv_id, turn, role, text).

    The style of the markers is drawn by a hash of the conversation, as mixed
    sources have it: names with a colon, other names, tags, headings, or bold
    names. Turns stand in order of turn, then role and text; nulls are empty. A
    row without conv_id is a transcript of its own.
    """
    style = F.pmod(F.xxhash64("conv_id"), F.lit(5))
    role = F.coalesce("role", F.lit("user"))
    other = F.when(role == "assistant", "AI").when(role == "system", "Instructions").otherwise("Human")
    named = (
        F.when(style == 0, F.concat(F.initcap(role), F.lit(": ")))
        .when(style == 1, F.concat(other, F.lit(": ")))
        .when(style == 2, F.concat(F.lit("<|"), role, F.lit("|>\n")))
        .when(style == 3, F.concat(F.lit("### "), F.initcap(role), F.lit("\n")))
        .otherwise(F.concat(F.lit("**"), other, F.lit("**: ")))
    )
    line = F.concat(named, F.coalesce("text", F.lit("")))
    parts = turns_.select("conv_id", F.struct(F.col("turn"), role.alias("role"), line.alias("line")).alias("part"))
    ordered = F.sort_array(F.collect_list("part"))
    whole = parts.filter("conv_id IS NOT NULL").groupBy("conv_id").agg(
        F.array_join(F.transform(ordered, lambda p: p["line"]), "\n").alias("text")
    )
    return whole.unionByName(parts.filter("conv_id IS NULL").select("conv_id", F.col("part.line").alias("text")))


def _labelled(turns_: DataFrame, conversations: int) -> DataFrame:
    """(conv_id, role, first, line, place) of a bounded sample of conversations, with the lines' known roles."""
    n = turns_.agg(F.approx_count_distinct("conv_id").alias("n")).first()["n"]
    share = int(min(1.0, conversations / max(n, 1)) * _SCALE)
    drawn = turns_.filter(F.pmod(F.xxhash64(F.lit(7), "conv_id"), F.lit(_SCALE)) < share)
    drawn = drawn.filter(F.col("role").isin(*ROLES) & F.col("text").isNotNull() & F.col("conv_id").isNotNull())
    return drawn.select("conv_id", "turn", "role", "text")


def train(turns_: DataFrame, conversations: int = SAMPLE) -> Hmm:
    """A model counted from conversations with known roles; every count starts at one, and half of a marker's
    names are counted as the right role's, since sources differ in how they mark speakers."""
    drawn = _labelled(turns_, conversations)
    n = len(STATES)
    start, step = [1.0] * n, [[1.0] * n for _ in range(n)]
    emit = [[[1.0] * size for _ in range(n)] for size in _SIZES]
    rows = drawn.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    for r in rows.select("turns").toLocalIterator():  # a bounded sample
        before = None
        for k, t in enumerate(r["turns"]):
            marked = k % 4 != 3  # some sources leave markers out
            for i, line in enumerate(t["text"].splitlines() or [""]):
                state = STATES.index((t["role"], i == 0))
                named = f"{t['role']}: {line}" if i == 0 and marked else line
                if before is None:
                    start[state] += 1
                else:
                    step[before][state] += 1
                for f, v in enumerate(features(named)):
                    emit[f][state][v] += 1
                before = state
    for s, (role, first) in enumerate(STATES):  # what a marker says, beside what is counted
        if first:
            emit[0][s][1 + ROLES.index(role)] += sum(emit[0][s])
    for s, (role, first) in enumerate(STATES):  # a turn goes on in its own role only
        for r, (other, after) in enumerate(STATES):
            if not after and other != role:
                step[s][r] = 1e-6
    start = [x if STATES[s][1] else 1e-6 for s, x in enumerate(start)]
    log = lambda row: [math.log(x / sum(row)) for x in row]
    return Hmm(log(start), [log(row) for row in step], [[log(row) for row in feature] for feature in emit])


def parse(texts: DataFrame, model: Hmm, id_col: str = "conv_id", text_col: str = "text") -> DataFrame:
    """(id, n_turns, roles, rendered) per transcript: roles joined by commas, and the canonical rendering.

    Null and empty texts have no turn and an empty rendering; a text without any
    marker is split by the model's line features alone; whole texts are parsed,
    in time linear in their lines; repeated rows, null ids and empty tables stay;
    other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, column in slices(batches, text_col):
            found = [turns(model, t) for t in column.to_pylist()]
            yield pa.record_batch(
                [
                    rows.column(id_col),
                    pa.array([len(f) for f in found], pa.int64()),
                    pa.array([",".join(r for r, _ in f) for f in found]),
                    pa.array([render(f) for f in found]),
                ],
                ["id", "n_turns", "roles", "rendered"],
            )

    kind = texts.schema[id_col].dataType.simpleString()
    out = texts.select(id_col, text_col).mapInArrow(run, f"id {kind}, n_turns long, roles string, rendered string")
    return out.withColumnRenamed("id", id_col)
