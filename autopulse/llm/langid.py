"""Language identification by cross-parsing entropy.

For each language a suffix automaton is built over labelled text.  A text is parsed greedily
against it: the longest match from the current place that is a substring of the labelled text
is one phrase, and the next begins behind it.  A text close to the language needs few phrases.
The count is normalised by the cost of naming a place in the labelled text,
``phrases * log2(states)``, and the language with the least cost per byte wins.

Texts are bytes of the lower-cased UTF-8 text with ASCII letters, one class for all other ASCII
(white space, digits, punctuation) and the bytes from 0x80 on as they are.  Whole texts are
parsed, in blocks of ``BLOCK`` bytes (a phrase ends at a block's end), so that thousands of
blocks of many texts advance together in array operations.

Fitting uses a bounded sample (documented parameters): per language the ``sample_rows``
labelled rows with the smallest id hashes outside the held-out fold, ``sample_bytes`` of each.
The automata are bounded by the sample, so their broadcast does not grow with the data.

Defined cases: a null text or one without a letter gets ``und`` with score 0; equal costs go to
the smaller language value; with no labelled row every text gets ``und``; rows whose lang is
null train nothing; repeated rows get the same answer; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from autopulse.llm.common import held_out, map_batches, slices, text_buffer

BLOCK = 256
UNKNOWN = "und"


def _classes() -> np.ndarray:
    """Class of each byte: 1 for other ASCII, then the letters, then the bytes from 0x80 on."""
    out = np.ones(256, np.int64)
    for i, letter in enumerate("abcdefghijklmnopqrstuvwxyz"):
        out[ord(letter)] = 2 + i
    out[0x80:] = 28 + np.arange(128) % 64  # lead and continuation bytes share classes; a lead names the script
    out[0xC0:] = 92 + np.arange(64)
    return out


CLASS = _classes()
SYMBOLS = 156


@dataclass(frozen=True)
class Automata:
    """``table[start_l + state * width + symbol]`` is ``2 * next + new_phrase`` for each language l."""

    langs: tuple[str, ...]
    column: np.ndarray  # byte class -> dense symbol used in the tables
    width: int
    tables: np.ndarray
    roots: np.ndarray
    cost: np.ndarray


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of a sequence (online construction)."""
    nxt: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for c in symbols:
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(nxt)
                nxt.append(dict(nxt[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p != -1 and nxt[p].get(c) == q:
                    nxt[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return nxt


def build(samples: dict[str, list[bytes]]) -> Automata:
    """One automaton per language; texts are joined by a symbol that no text has."""
    langs = tuple(sorted(samples))
    classes = {lang: [CLASS[np.frombuffer(t, np.uint8)] for t in samples[lang] if t] for lang in langs}
    used = sorted({int(c) for parts in classes.values() for p in parts for c in np.unique(p)})
    dense = np.zeros(SYMBOLS, np.int64)  # 0: in no labelled text
    for i, c in enumerate(used):
        dense[c] = i + 2
    width = len(used) + 2  # 0: unseen symbol, 1: padding
    tables, roots, cost, start = [], [], [], 0
    for lang in langs:
        joined: list[int] = []
        for p in classes[lang]:
            joined.extend(dense[p].tolist())
            joined.append(-1)
        nxt = suffix_automaton(joined)
        table = np.zeros((len(nxt), width), np.int64)
        begin = np.zeros(width, np.int64)
        for c, s in nxt[0].items():
            if c >= 0:
                begin[c] = s
        table[:] = 2 * begin + 1  # no transition: a new phrase begins with this symbol
        for s, moves in enumerate(nxt):
            for c, t in moves.items():
                if c >= 0 and s:
                    table[s, c] = 2 * t
        # states are kept as row starts in the joined table
        flag, state = table & 1, table >> 1
        table = 2 * (start + state * width) + flag
        table[:, 1] = 2 * start  # padding ends a block without a phrase
        tables.append(table.ravel())
        roots.append(start)
        cost.append(math.log2(len(nxt) + 1))
        start += table.size
    flat = np.concatenate(tables) if tables else np.zeros(0, np.int64)
    return Automata(langs, dense[CLASS], width, flat.astype(np.int32) if start < 1 << 30 else flat,
                    np.array(roots), np.array(cost))


def phrases(data: np.ndarray, offsets: np.ndarray, model: Automata) -> np.ndarray:
    """Phrases of each text against each language (texts x languages)."""
    sizes = np.diff(offsets)
    blocks = -(-sizes // BLOCK)
    first = np.concatenate(([0], np.cumsum(blocks)))
    grid = np.ones(int(first[-1]) * BLOCK, np.int32)  # padding
    shift = np.repeat(first[:-1] * BLOCK - offsets[:-1], sizes)
    grid[np.arange(len(data)) + shift] = model.column[data]
    grid = np.ascontiguousarray(grid.reshape(-1, BLOCK).T)
    out = np.zeros((len(sizes), len(model.langs)), np.int64)
    for j, root in enumerate(model.roots):
        state = np.full(grid.shape[1], root, model.tables.dtype)
        count = np.zeros(grid.shape[1], np.int64)
        for row in grid:
            state = state + row
            moved = model.tables[state]
            count += moved & 1
            state = moved >> 1
        total = np.concatenate(([0], np.cumsum(count)))
        out[:, j] = total[first[1:]] - total[first[:-1]]
    return out


def predict_column(column: pa.Array, model: Automata) -> tuple[list[str], np.ndarray]:
    column = pc.fill_null(column, "")
    letters = np.array(pc.match_substring_regex(column, r"\pL").to_pylist(), dtype=bool)
    data, offsets = text_buffer(pc.utf8_lower(column))
    if not model.langs:
        return [UNKNOWN] * len(column), np.zeros(len(column))
    cost = phrases(data, offsets, model) * model.cost
    best = cost.argmin(axis=1)
    least = cost[np.arange(len(cost)), best]
    if len(model.langs) > 1:
        second = np.partition(cost, 1, axis=1)[:, 1]
        score = np.where(second > 0, 1 - least / np.maximum(second, 1e-9), 0.0)
    else:
        score = np.ones(len(cost))
    langs = [model.langs[b] if ok else UNKNOWN for b, ok in zip(best, letters)]
    return langs, np.where(letters, score, 0.0)


def labelled_sample(docs: DataFrame, sample_rows: int = 24, sample_bytes: int = 3000, id_col: str = "doc_id",
                    text_col: str = "text", lang_col: str = "lang", fold: int = 4, out: int = 2) -> dict[str, list[bytes]]:
    """Bounded labelled text per language: ``sample_rows`` rows, ``sample_bytes`` of each."""
    usable = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & ~held_out(id_col, fold, out))
    cut = F.substring(F.lower(text_col), 1, sample_bytes)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("cut")))
    rows = (usable.select(F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"), cut.alias("cut"))
            .withColumn("rank", rank).where(F.col("rank") <= sample_rows).orderBy("lang", "rank").collect())
    out_: dict[str, list[bytes]] = {}
    for r in rows:
        out_.setdefault(r["lang"], []).append(r["cut"].encode()[:sample_bytes])
    return out_


def identify(docs: DataFrame, model: Automata, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score`` of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, limit=2 << 20):
                langs, score = predict_column(part.column("text"), shared.value)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(langs, pa.string()), pa.array(score)],
                    names=["doc_id", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_batches(rows, run, f"doc_id {kind}, lang_pred string, score double")


def language_id(docs: DataFrame, **sample) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row of ``docs``."""
    return identify(docs, build(labelled_sample(docs, **sample))).select(
        "doc_id", held_out("doc_id", 4, 2).alias("held_out"), "lang_pred", "score")
