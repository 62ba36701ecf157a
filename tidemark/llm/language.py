"""Language identification by cross-parsing against suffix automata.

For each language a suffix automaton is built from a bounded sample of its
labelled text. A text is parsed from left to right into the longest pieces that
occur in that sample; the cross-parsing estimate of its entropy under the
language is (phrases x log2 of the sample's length) / length, and the language
with the fewest phrases so normalised wins.

Automata work on bytes of lower-cased text: a-z and the bytes of other letters
each have a symbol, anything else is one blank however long. Their transitions
are dense tables, broadcast (``symbols_per_language`` bounds each; with many
languages ``symbols_in_all`` bounds them together, to some 100 MB). Whole texts are
parsed; all segments of a block run in step, each as if a phrase began with it, so
the cost is a few array look-ups a byte and language. Then each segment is run
again from the state in which the one before it ended, until the two runs meet,
which takes some symbols; the result is the parsing of the whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidemark.llm.common import ready
from tidemark.llm.textblocks import slices

UNDETERMINED = "und"
SEGMENT = 256
#: Rounds in which ends of segments are passed on to all that follow at once; what then still changes is passed on one by one.
ROUNDS = 4


def fold_of(doc_id: Column) -> Column:
    """crc32 of the id as text, mod 5; rows with 0 are held out."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(5))


def symbols(raw: np.ndarray) -> np.ndarray:
    """a-z as 1-26, bytes from 0x80 as themselves, all else 0."""
    return _SYMBOL[raw]


_SYMBOL = np.zeros(256, np.uint8)
_SYMBOL[ord("a") : ord("z") + 1] = np.arange(1, 27)
_SYMBOL[0x80:] = np.arange(0x80, 0x100)


def suffix_automaton(text: np.ndarray) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of ``text``; state 0 is the start."""
    out: list[dict[int, int]] = [{}]
    length, link, last = [0], [-1], 0
    for c in text.tolist():
        state = len(out)
        out.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and c not in out[p]:
            out[p][c] = state
            p = link[p]
        if p != -1:
            q = out[p][c]
            if length[p] + 1 == length[q]:
                link[state] = q
            else:
                copy = len(out)
                out.append(dict(out[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p != -1 and out[p].get(c) == q:
                    out[p][c] = copy
                    p = link[p]
                link[q] = link[state] = copy
        last = state
    return out


@dataclass(frozen=True)
class LanguageModel:
    """Languages in code-point order; per language a transition table and log2 of its sample's length.

    ``column`` maps a symbol to a table column; column 0 is for symbols that no
    sample has, the last one pads segments. Entries are row starts, -1 for none.
    Each table gets one more row, without a transition: there a text begins, and
    there a symbol that the sample lacks leads, a phrase by itself.
    """

    languages: tuple[str, ...]
    column: np.ndarray
    width: int
    tables: tuple[np.ndarray, ...]
    bits: tuple[float, ...]

    def __post_init__(self) -> None:
        def closed(table: np.ndarray) -> np.ndarray:
            none = np.full(self.width, -1, np.int32)
            none[-1] = len(table)
            return np.concatenate([table, none])

        object.__setattr__(self, "tables", tuple(map(closed, self.tables)))

    def phrases(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Phrases x log2(sample length) of each text, a row per text and a column per language."""
        texts = len(offsets) - 1
        sym = symbols(raw)
        kept = np.ones(len(sym), bool)
        kept[1:] = (sym[1:] != 0) | (sym[:-1] != 0)
        starts = offsets[:-1][offsets[:-1] < len(sym)]
        kept[starts] = True
        ends = np.concatenate([[0], np.cumsum(kept)])[offsets]
        cols = self.column[sym[kept]]
        sizes = np.diff(ends)
        per = -(-sizes // SEGMENT)
        owner = np.repeat(np.arange(texts), per)
        out = np.zeros((texts, len(self.languages)))
        if not len(owner):
            return out
        grid = np.full((len(owner), SEGMENT), self.width - 1, np.uint8)
        first = np.cumsum(per) - per
        place = np.arange(len(cols)) - np.repeat(ends[:-1], sizes) + np.repeat(first * SEGMENT, sizes)
        grid.reshape(-1)[place] = cols
        steps = np.ascontiguousarray(grid.T)
        follows = np.concatenate([[False], owner[1:] == owner[:-1]])
        for k, (table, bits) in enumerate(zip(self.tables, self.bits)):
            out[:, k] = np.bincount(owner, _misses(table, self.width, steps, follows), texts) * bits
        return out


def _misses(table: np.ndarray, width: int, steps: np.ndarray, follows: np.ndarray) -> np.ndarray:
    """Phrases that begin in each segment; one that follows another goes on in its state."""
    none = np.int32(len(table) - width)
    root = np.where(table[:width] < 0, none, table[:width]).astype(np.int32)
    lanes = steps.shape[1]
    state = np.full(lanes, none, np.int32)
    states, missed = [], []
    for step in steps:
        after = table.take(state + step)
        miss = after < 0
        state = np.where(miss, root.take(step), after)
        states.append(state)
        missed.append(miss)
    count = np.sum(missed, axis=0, dtype=np.int32)
    start = np.full(lanes, none, np.int32)

    def rerun(dirty: np.ndarray, wanted: np.ndarray) -> None:
        """Run segments from other states until they meet their old runs, which are put right."""
        start[dirty] = wanted
        now = wanted
        for t, step in enumerate(steps):
            after = table.take(now + step[dirty])
            miss = after < 0
            now = np.where(miss, root.take(step[dirty]), after)
            count[dirty] += miss.astype(np.int32) - missed[t][dirty]
            met = now == states[t][dirty]
            states[t][dirty] = now
            missed[t][dirty] = miss
            if met.any():
                dirty, now = dirty[~met], now[~met]
                if not len(dirty):
                    return

    def differing() -> tuple[np.ndarray, np.ndarray]:
        before = np.where(follows, np.concatenate([[none], states[-1][:-1]]), none).astype(np.int32)
        dirty = np.flatnonzero(before != start)
        return dirty, before[dirty]

    for _ in range(ROUNDS):
        dirty, wanted = differing()
        if not len(dirty):
            return count
        rerun(dirty, wanted)
    for lane in range(int(differing()[0][0]) if len(differing()[0]) else lanes, lanes):
        before = states[-1][lane - 1] if follows[lane] else none
        if before != start[lane]:
            rerun(np.array([lane]), np.array([before], np.int32))
    return count


def _shares(rows: list[np.ndarray], bound: int) -> list[np.ndarray]:
    """The rows, the longer ones cut to one length, so that they have ``bound`` symbols at most."""
    left, most = bound, 0
    for k, size in enumerate(sorted(map(len, rows))):
        most = left // (len(rows) - k)
        if size > most:
            break
        left, most = left - size, size
    return [r[: max(1, most)] for r in rows][:bound]


def fit(docs: DataFrame, rows_per_language: int = 64, symbols_per_language: int = 16_384, symbols_in_all: int = 1 << 18, rows_in_all: int = 4096) -> LanguageModel:
    """Learn from text and lang of rows that are not held out.

    Per language the ``rows_per_language`` rows with the least hash of the id
    are read (fewer if with all languages they would be more than
    ``rows_in_all``), and of them ``symbols_per_language`` symbols at most are
    used: shorter rows whole, of longer ones an equal share from a place that
    the id's hash says.
    """
    labelled = docs.select("doc_id", "text", "lang").filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold_of(F.col("doc_id")) != 0))
    languages = max(1, labelled.select("lang").distinct().count())
    rows_per_language = max(1, min(rows_per_language, rows_in_all // languages))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    chosen = labelled.select("doc_id", "lang").withColumn("_r", rank).filter(F.col("_r") <= rows_per_language)
    chosen = chosen.select(F.col("doc_id").alias("_id"), F.col("lang").alias("_lang")).distinct()
    wanted = labelled.join(F.broadcast(chosen), (F.col("doc_id").eqNullSafe(F.col("_id"))) & (F.col("lang") == F.col("_lang")))
    bound = max(1, min(symbols_per_language, symbols_in_all // languages))
    spare = F.greatest(F.length("text") - bound, F.lit(0))
    stretch = F.substring("text", F.lit(1) + F.pmod(F.xxhash64("doc_id"), spare + 1).cast("int"), F.lit(bound))
    sample: dict[str, list[np.ndarray]] = {}
    for lang, text, _ in wanted.select("lang", F.lower(stretch), F.xxhash64("doc_id").alias("h")).distinct().orderBy("lang", "h").toLocalIterator():
        sym = symbols(np.frombuffer((text + " ").encode(), np.uint8))
        kept = np.ones(len(sym), bool)
        kept[1:] = (sym[1:] != 0) | (sym[:-1] != 0)
        if sym.any() and len(sample.setdefault(lang, [])) < rows_per_language:
            sample[lang].append(sym[kept])
    texts = {lang: np.concatenate(_shares(sample[lang], bound)) for lang in sorted(sample) if sample[lang]}
    used = sorted(set().union(*(set(np.unique(t).tolist()) for t in texts.values()))) if texts else []
    column = np.zeros(256, np.uint8)
    for k, s in enumerate(used):
        column[s] = k + 1
    width = len(used) + 2
    tables = []
    for text in texts.values():
        states = suffix_automaton(column[text])
        table = np.full((len(states), width), -1, np.int32)
        for s, moves in enumerate(states):
            for c, to in moves.items():
                table[s, c] = to * width
        table[:, width - 1] = np.arange(len(states)) * width
        tables.append(table.reshape(-1))
    return LanguageModel(tuple(texts), column, width, tuple(tables), tuple(float(np.log2(max(2, len(t)))) for t in texts.values()))


def identify(docs: DataFrame, model: LanguageModel, text: str = "text", lang_as: str = "lang_pred", score_as: str = "score") -> DataFrame:
    """The rows with two more columns: the language that wins, and how clearly.

    The score is the runner-up's share of both parsings' lengths, from 0.5 (a
    tie; the first language in code-point order is taken) towards 1; with one
    language it is 1. Defined cases: a null text, a text without a letter, and
    every text when nothing was learned are ``und`` with score 0; texts of any
    length are parsed whole; repeated rows get equal results; an empty table
    stays empty.
    """
    ready(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns
    lowered = F.lower(F.coalesce(F.col(text).cast("string"), F.lit("")))
    work = docs.select("*", lowered.alias("_tidemark_lower"), F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("_tidemark_letter"))
    schema = T.StructType([*docs.schema.fields, T.StructField(lang_as, T.StringType()), T.StructField(score_as, T.DoubleType())])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for part, raw, offsets in slices(batch, "_tidemark_lower"):
                letter = part.column("_tidemark_letter").to_numpy(zero_copy_only=False)
                lang, score = np.full(part.num_rows, UNDETERMINED, object), np.zeros(part.num_rows)
                if model.languages:
                    cost = model.phrases(raw, offsets)
                    best = np.argmin(cost, axis=1)
                    two = np.sort(cost, axis=1)[:, :2]
                    second = two[:, -1] if two.shape[1] > 1 else np.zeros(part.num_rows)
                    clear = second / np.maximum(two[:, 0] + second, 1e-9) if two.shape[1] > 1 else np.ones(part.num_rows)
                    lang = np.where(letter, np.array(model.languages, object)[best], UNDETERMINED)
                    score = np.where(letter, clear, 0.0)
                columns = [part.column(k) for k in range(len(names))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=[*names, lang_as, score_as])

    return work.mapInArrow(parse, schema)


def predict_languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every document, learned from those not held out."""
    model = fit(docs.select("doc_id", "text", "lang"))
    found = identify(docs.select(F.col("doc_id").cast("long").alias("doc_id"), (fold_of(F.col("doc_id")) == 0).alias("held_out"), "text"), model)
    return found.select("doc_id", "held_out", "lang_pred", "score")
