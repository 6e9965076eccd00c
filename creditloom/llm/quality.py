"""Quality by weak supervision: rules vote or abstain, EM estimates how far to trust each, the posterior decides.

Each rule looks at one feature of a text and votes good (1), bad (-1) or abstains (0). A two-class latent model with
rules independent given the class is fitted by expectation-maximisation on the counts of vote patterns over all
documents: at most 3 ** rules patterns leave the executors, whatever the size of the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.llm.common import SPACES, stored

SYMBOLS = "#*$%&|<>"
FEATURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct", "n_upper", "n_letters", "n_digits"]


def text_features(text: str | None) -> tuple[int, ...]:
    """Values of ``FEATURES``; a null text counts as empty.

    Words are runs of anything but the six ASCII spaces. ``n_repeat_words`` counts the words that lie in a window of
    three words found twice or more in the text, the first place included.
    """
    if not text:
        return (0,) * len(FEATURES)
    words = text.encode("utf-8", "surrogatepass").split()
    n = len(words)
    seen: set[str] = set()
    lines = dup = 0
    for line in text.split("\n"):
        if line.strip(SPACES):
            lines += 1
            dup += line in seen
            seen.add(line)
    ids: dict[bytes, int] = {}
    codes = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
    repeated = 0
    if n > 3:
        pair = codes[:-1] * len(ids) + codes[1:]
        if len(ids) >= 1 << 20:
            pair = np.unique(pair, return_inverse=True)[1]
        _, where, times = np.unique(pair[:-1] * len(ids) + codes[2:], return_inverse=True, return_counts=True)
        hit = times[where] > 1
        covered = np.zeros(n, bool)
        for shift in range(3):
            covered[shift : n - 2 + shift] |= hit
        repeated = int(covered.sum())
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    upper = int(((raw >= 65) & (raw <= 90)).sum())
    letters = upper + int((((raw >= 97) & (raw <= 122)) | (raw >= 192)).sum())  # beyond ASCII a character counts as a letter
    digits = int(((raw >= 48) & (raw <= 57)).sum())
    return n, len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)), dup, repeated, lines, len(ids), upper, letters, digits


def ratio(a: str, b: str) -> Column:
    return F.col(a) / F.greatest(F.col(b), F.lit(1))


@dataclass(frozen=True)
class Rule:
    """Votes bad where ``value`` reaches ``bad``, good up to ``good``, abstains between and where ``applies`` is false."""

    name: str
    value: Column
    good: float
    bad: float
    applies: Column | None = None

    def vote(self) -> Column:
        vote = F.when(self.value >= self.bad, -1).when(self.value <= self.good, 1).otherwise(0)
        return vote if self.applies is None else F.when(self.applies, vote).otherwise(0)


def default_rules() -> list[Rule]:
    word_length = ratio("word_chars", "n_words")
    return [
        Rule("symbols", ratio("n_symbols", "n_words"), good=0.01, bad=0.1),
        Rule("repeated windows", ratio("n_repeat_words", "n_words"), good=0.15, bad=0.4),
        Rule("repeated lines", ratio("n_dup_lines", "n_lines"), good=0.0, bad=0.5, applies=F.col("n_lines") > 1),
        Rule("letters and digits", 1 - (F.col("n_letters") + F.col("n_digits")) / F.greatest("word_chars", F.lit(1)), good=0.06, bad=0.12, applies=F.col("n_words") > 0),
        Rule("capitals", ratio("n_upper", "n_letters"), good=0.1, bad=0.3, applies=F.col("n_letters") > 0),
        Rule("vocabulary", 1 - ratio("n_distinct", "n_words"), good=0.6, bad=0.85),
        Rule("word length", F.greatest(word_length / 12, 3 / F.greatest(word_length, F.lit(0.1))), good=1.0, bad=1.7, applies=F.col("n_words") > 0),
    ]


@dataclass(frozen=True)
class VoteModel:
    """``prior`` of a good document; ``tables[rule, class, vote + 1]`` with class 1 = good."""

    prior: float
    tables: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Probability that documents with these votes (rows of -1, 0, 1) are good."""
        log = np.log(self.tables)
        odds = np.log(self.prior / (1 - self.prior)) + sum((log[j, 1] - log[j, 0])[votes[:, j] + 1] for j in range(votes.shape[1]))
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def fit_votes(votes: np.ndarray, counts: np.ndarray, rounds: int = 200) -> VoteModel:
    """EM on distinct vote patterns with their counts.

    It starts from the belief that any bad vote is right; the documents then say how far each rule is to be trusted.
    A bad vote never speaks for a document and a good one never against it, which keeps the two classes from changing
    places. No documents: every document is as likely good as bad.
    """
    rules = votes.shape[1]
    good = np.where((votes < 0).any(axis=1), 0.05, 0.95)
    for _ in range(rounds):
        weight = np.stack([counts * (1 - good), counts * good])
        prior = float((weight[1].sum() + 1) / (weight.sum() + 2))
        tables = np.ones((rules, 2, 3))
        for j in range(rules):
            for v in (-1, 0, 1):
                tables[j, :, v + 1] += weight[:, votes[:, j] == v].sum(axis=1)
        tables /= tables.sum(axis=2, keepdims=True)
        # a vote must not point the other way
        for v, high in ((0, 0), (2, 1)):
            both = tables[:, :, v].mean(axis=1)
            wrong = tables[:, high, v] < tables[:, 1 - high, v]
            tables[wrong, :, v] = both[wrong, None]
        tables /= tables.sum(axis=2, keepdims=True)
        model = VoteModel(prior, tables)
        new = model.posterior(votes)
        if len(new) == 0 or np.abs(new - good).max() < 1e-9:
            break
        good = new
    return model


def features(docs: DataFrame, text_col: str) -> DataFrame:
    """``(row, *FEATURES)``: each row of ``docs`` as a struct, and the features of its text; a null text gives zeros."""
    schema = f"row {docs.schema.simpleString()}, " + ", ".join(f"{f} long" for f in FEATURES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([text_features(t) for t in batch.column(1).to_pylist()], np.int64).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, values.T.copy())], ["row", *FEATURES])

    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    return rows.select("row", F.col("row").getField(text_col).cast("string").alias("text")).mapInArrow(run, schema)


#: Fewest words of a document, and percent of its words in repeated windows beyond which it fails whatever the votes.
FEWEST_WORDS, MOST_REPEATED = 50, 50
#: Posterior probability from which a document is kept.
KEPT = 0.5


def base_failed() -> Column:
    return (F.col("n_words") < FEWEST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def kept() -> Column:
    return ~base_failed() & (F.col("quality") >= KEPT)


def posteriors(voted: DataFrame, rules: int) -> DataFrame:
    """``(votes, quality)``: the fitted probability of every pattern of votes that occurs, to be broadcast."""
    patterns = voted.groupBy("votes").count().collect()  # 3 ** rules at most
    table = np.array([[int(v) for v in p["votes"].split(",")] for p in patterns], int).reshape(-1, rules)
    model = fit_votes(table, np.array([p["count"] for p in patterns], float))
    fitted = [(p["votes"], float(q)) for p, q in zip(patterns, model.posterior(table), strict=True)]
    return F.broadcast(voted.sparkSession.createDataFrame(fitted, "votes string, quality double"))


def votes_of(rules: Sequence[Rule]) -> Column:
    return F.concat_ws(",", *(r.vote().cast("string") for r in rules)).alias("votes")


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Sequence[Rule] | None = None) -> DataFrame:
    """``(id_col, *FEATURES, votes, quality)``; ``quality`` is the posterior probability of a good document.

    One pass over the texts: the features are stored in the shared folder, the patterns are counted there, and the
    fitted probability of each pattern comes back through a broadcast of at most 3 ** rules rows. An empty table gives
    an empty result. Repeated rows count as often as they occur; a null id is kept; other columns are not read.
    """
    rules = list(rules or default_rules())
    found = features(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "text")
    voted = stored(found.select(F.col("row.id").alias("id"), *FEATURES, votes_of(rules)))
    return voted.join(posteriors(voted, len(rules)), "votes", "left").withColumnRenamed("id", id_col)


def keep(docs: DataFrame, text_col: str = "text", rules: Sequence[Rule] | None = None) -> DataFrame:
    """The rows of ``docs`` that are kept, all columns as they are; cases as in ``score``, a null text goes.

    The features are computed once to fit the model and again beside the rows, which moves no text between machines.
    """
    rules = list(rules or default_rules())
    found = features(docs.select(F.col(text_col).alias("text")), "text").select(votes_of(rules))
    judged = features(docs, text_col).withColumn("votes", votes_of(rules)).join(posteriors(found, len(rules)), "votes", "left")
    return judged.where(kept()).select("row.*")
