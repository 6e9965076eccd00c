"""Toxicity behind disguises: decode what letters were meant, then score the restored words.

Tokens that look disguised (digits or signs among letters, letters drawn out, letters spaced out) are lattices of
possible letters. Viterbi finds the likeliest reading under a trigram model of letters, counted over all documents, and
a channel that prices substitutions, dropped separators and repetitions. Restored words are scored by how surely they
mark toxic documents among the labelled ones.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.llm.common import shipped, stored

#: Letters a-z are 1 to 26, anything beyond ASCII is 27, all else ends a word.
SYMBOLS = 28
# Readings of digits and signs.
READINGS = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t"}
DROPPED = "._-*~^'`"
#: Log probabilities of the channel.
SUBSTITUTED, SEPARATED, REPEATED = -1.0, -0.3, -0.3
#: Log probability of a word break between letters that stand apart; that of a separator, as the letters decide.
BROKEN = SEPARATED
#: Longest token that ``known`` keeps.
LONGEST_KNOWN = 40
#: Labelled documents used at most, chosen by a hash of their id.
MAX_LABELLED = 50_000
#: Labelled documents in which a word must occur.
LEAST_DOCUMENTS = 5
#: Letters of the word beginnings that count as well, marked by a star.
BEGINNINGS = (4, 5)
#: Lower bound of the share of toxic documents from which a word is a candidate.
SURE = 0.3
#: Pull of the weights to zero.
RIDGE = 0.1
#: Words counted in a task before their counts are handed on.
PART = 200_000
EDGES = "".join(map(chr, range(33, 48))) + ":;<=>?@[\\]^_`{|}~«»¡¿…“”"
OUTER = EDGES.replace("@", "").replace("$", "").replace("|", "")
DRAWN = re.compile(r"(.)\1\1")
#: Characters that stand apart: each but the last has a separator after it.
SPREAD = re.compile(r"(?s)(?:[^ ._*~^'`-][ ._*~^'`-]){3,}[^ ._*~^'`-]")
SPACED = re.compile(r"(?<!\S)(?:\S[ ]){3,}\S(?!\S)")
CODES = np.zeros(256, np.int64)
CODES[ord("a") : ord("z") + 1] = CODES[ord("A") : ord("Z") + 1] = np.arange(1, 27)
CODES[128:] = 27


def letter_counts(docs: DataFrame, text_col: str) -> np.ndarray:
    """Trigrams of letter classes over all documents; at most 28 ** 3 sums come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SYMBOLS**3, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                s = CODES[np.frombuffer(f"  {text or ''}  ".encode("utf-8", "surrogatepass"), np.uint8)]
                total += np.bincount((s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:], minlength=SYMBOLS**3)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["code", "n"])

    counted = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    total = np.zeros(SYMBOLS**3)
    for row in counted.collect():
        total[row["code"]] = row["n"]
    return total.reshape(SYMBOLS, SYMBOLS, SYMBOLS)


def letter_model(counts: np.ndarray) -> np.ndarray:
    """Log probability of a letter after two, mixed with the one after one."""
    pairs = counts.sum(axis=0) + 0.5
    after_one = pairs / pairs.sum(axis=1, keepdims=True)
    return np.log((counts + 5 * after_one[None]) / (counts.sum(axis=2, keepdims=True) + 5))


def readings(char: str) -> list[tuple[str, float]]:
    """What a character may stand for, with its price; the empty string drops it."""
    if char in READINGS:
        return [(c, SUBSTITUTED) for c in READINGS[char]] + ([("", SEPARATED)] if char in DROPPED else [])
    return [("", SEPARATED)] if char in DROPPED or char == " " else [(char, 0.0)]


def code(char: str) -> int:
    return ord(char) - 96 if "a" <= char <= "z" else 27 if ord(char) > 127 else 0


def decode(token: str, model: np.ndarray) -> list[str]:
    """Words of the likeliest reading of a token, and all of them as one, by Viterbi; a state is the last two letters.

    Where characters stand apart, a dropped separator may also end a word. Readings are linked backwards, so that the
    work goes with the length of the token.
    """
    apart = SPREAD.fullmatch(token) is not None
    best: dict[tuple[int, int], tuple[float, str, tuple | None]] = {(0, 0): (0.0, "", None)}
    for char in token:
        step: dict[tuple[int, int], tuple[float, str, tuple | None]] = {}
        ways = readings(char)
        for (a, b), (score, last, before) in best.items():
            for letter, price in ways:
                c = code(letter) if letter else None
                state = (a, b) if c is None else (b, c)
                value = score + price + (0.0 if c is None else float(model[a, b, c]))
                if state not in step or value > step[state][0]:
                    step[state] = (value, letter or last, (letter, before) if letter else before)
            if last and last != " " and any(c == last for c, _ in ways) and ((a, b) not in step or score + REPEATED > step[a, b][0]):
                step[a, b] = (score + REPEATED, last, before)
            if apart and last and last != " " and any(not c for c, _ in ways):
                value = score + BROKEN + float(model[a, b, 0])
                if (b, 0) not in step or value > step[b, 0][0]:
                    step[b, 0] = (value, " ", (" ", before))
        best = step
    link = max(((score + (float(model[a, b, 0]) if last != " " else 0.0), last, back) for (a, b), (score, last, back) in best.items()), key=lambda x: x[:2])[2]
    letters = []
    while link:
        letters.append(link[0])
        link = link[1]
    words = "".join(reversed(letters)).split(" ")
    return words if len(words) == 1 else [*words, "".join(words)]


def restored(text: str | None, model: np.ndarray, known: dict[str, list[str]]) -> set[str]:
    """Distinct words of a text in lower case, disguised ones decoded, and their beginnings; ``known`` keeps decoded tokens."""
    low = (text or "").lower()
    words = set()
    for token in {*low.split(), *SPACED.findall(low)}:
        bare = token.strip(EDGES)
        if bare.isalpha() and not DRAWN.search(bare) and token.strip(OUTER) == bare:
            words.add(bare)
            continue
        disguised = token.strip(OUTER) if any(map(str.isalpha, token)) else ""
        if bare:
            words.add(bare)
        if len(disguised) > LONGEST_KNOWN:
            words.update(decode(disguised, model))
        elif disguised:
            if disguised not in known:
                if len(known) > 200_000:
                    known.clear()
                known[disguised] = decode(disguised, model)
            words.update(known[disguised])
    return words | {w[:n] + "*" for w in words for n in BEGINNINGS if len(w) > n}


@dataclass(frozen=True)
class ToxicityModel:
    letters: np.ndarray
    words: dict[str, float]
    bias: float

    def score(self, words: list[str]) -> float:
        """Of the distinct words of a text that the model knows."""
        return float(1 / (1 + np.exp(-self.bias - sum(self.words[w] for w in words))))


def logistic(rows: list[tuple[list[int], int]], width: int) -> tuple[np.ndarray, float]:
    """Ridge-penalised logistic regression on sets of features: weights and bias, by scaled gradient steps."""
    weights, bias = np.zeros(width), log(0.1 / 0.9)
    if not rows:
        return weights, bias
    row = np.repeat(np.arange(len(rows)), [len(r) for r, _ in rows])
    column = np.concatenate([np.asarray(r, np.int64) for r, _ in rows])
    y = np.array([t for _, t in rows], float)
    seen, seen_bias = np.full(width, 1e-9), 1e-9
    for _ in range(400):
        p = 1 / (1 + np.exp(-np.clip(bias + np.bincount(row, weights[column], len(rows)), -30, 30)))
        slope = np.bincount(column, (p - y)[row], width) + RIDGE * weights
        seen += slope**2
        seen_bias += (p - y).sum() ** 2
        weights -= 0.5 * slope / np.sqrt(seen)
        bias -= 0.5 * (p - y).sum() / np.sqrt(seen_bias)
    return weights, bias


def held_out(id_col: str) -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> ToxicityModel:
    """Letters from all documents, words from the labelled ones that are not held out.

    Exact copies of a text count once. Candidates are the words with the highest lower Wilson bound (z = 3) of the share
    of toxic documents among those with them; a logistic regression weighs them together.
    """
    spark = docs.sparkSession
    letters = letter_model(letter_counts(docs, text_col))
    usable = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(id_col))
    marked = usable.groupBy(F.col(id_col).alias("_id")).agg((F.max(label_col) > 0).cast("int").alias("_toxic"))
    sample = marked.orderBy(F.xxhash64("_id"), "_id").limit(MAX_LABELLED)
    shared = shipped(spark, letters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list[str]] = {}
        letters = shared()
        counts: dict[str, list[int]] = {}

        def part() -> pa.RecordBatch:
            clean, toxic = (pa.array([c[i] for c in counts.values()], pa.int64()) for i in (0, 1))
            return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), clean, toxic], ["word", "clean", "toxic"])

        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for word in restored(text, letters, known):
                    counts.setdefault(word, [0, 0])[toxic] += 1
                if len(counts) > PART:
                    yield part()
                    counts.clear()
        yield part()

    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("text"))
    copies = F.md5(F.col("text").cast("binary"))
    labelled = stored(texts.join(F.broadcast(sample), "_id").groupBy(copies).agg(F.first("text").alias("text"), F.max("_toxic").alias("_toxic")).select("text", "_toxic"))
    counted = labelled.mapInArrow(run, "word string, clean long, toxic long").groupBy("word").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    n, p, z = F.col("clean") + F.col("toxic"), F.col("toxic") / (F.col("clean") + F.col("toxic")), 3.0
    low = (p + z * z / (2 * n) - z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)
    candidates = counted.withColumn("low", low).where(f"low >= {SURE} AND clean + toxic >= {LEAST_DOCUMENTS}")
    chosen = [r["word"] for r in candidates.orderBy(F.desc("low"), "word").collect()]
    places = shipped(spark, {w: i for i, w in enumerate(chosen)})

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list[str]] = {}
        letters, place = shared(), places()
        for batch in batches:
            found = [sorted(place[w] for w in restored(t, letters, known) & place.keys()) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int64())), batch.column(1)], ["found", "toxic"])

    rows = [(r["found"], r["toxic"]) for r in labelled.mapInArrow(marks, "found array<long>, toxic int").collect()]  # MAX_LABELLED at most
    weights, bias = logistic(rows, len(chosen))
    return ToxicityModel(letters, dict(zip(chosen, weights.tolist(), strict=True)), bias)


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, score, words)``: probability of toxicity and the words that speak for it, one row per input row.

    Null and empty texts get the score of a text without telling words. Only the text enters the score; ids may be null or repeated.
    """
    shared = shipped(docs.sparkSession, model)
    schema = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, score double, words array<string>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list[str]] = {}
        model = shared()
        for batch in batches:
            marks = [sorted(restored(t, model.letters, known) & model.words.keys()) for t in batch.column(1).to_pylist()]
            scores = [model.score(w) for w in marks]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), pa.array(marks, pa.list_(pa.string()))], [id_col, "score", "words"])

    return docs.select(id_col, F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)
