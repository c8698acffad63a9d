"""Toxicity scores by a classifier whose answers may not depend on which group a text names.

A word's features are its beginnings of 3 to 7 bytes, lower-cased, and the word itself if it is that short, so an unseen
ending of a known stem still counts.  A text's logit is a bias plus its words' weights per 100 words (50 added to the
number of words, so a few words do not make a high rate): long clean texts do not add up small evidence.

Training reads a bounded sample of labelled texts.  Spark counts in how many texts of each label a feature stands;
those that tell the labels apart best are kept.  Weights are fitted by full gradients, which tasks sum over the
sample's rows.  Counterfactual regularisation: in every labelled sentence that names a group, the term is swapped
for each other term of its kind, the neutral word included, and the squared change of the sentence's logit is a penalty.
A swap changes the logit by the two words' difference over the sentence's length, so sentences are summed up by term
and the penalty is exact.  Each term counts as standing in one sentence of 20 words more than it does, so terms the sample lacks are held too.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import partitions, written
from quarry.llm.language_id import held_out
from quarry.llm.words import slices, text_bytes, tidy

#: Labelled texts of each label that teach, about (drawn by a hash of the id), features, and gradient rounds.
TRAIN_DOCS = 2000
FEATURES = 4096
ROUNDS = 40
#: A feature stands in at least so many toxic texts, and its G-test reaches this value (p = 0.001).
LEAST_TEXTS, LEAST_G = 2, 10.83
RATE, RIDGE, SWAP = 0.3, 1e-3, 10.0
THRESHOLD = 0.3
SHORTEST, LONGEST = 3, 7
#: A text's evidence is per PER words, with ADDED words more than it has.
PER, ADDED = 100.0, 50
#: Slots of the table that tells most beginnings apart from features, as a power of two.
SLOT_BITS = 18

#: Words that name groups of people, by kind and language; the last of each list is neutral.
IDENTITY_TERMS = {
    "religion, en": ["muslim", "christian", "jewish", "hindu", "buddhist", "catholic", "atheist", "sikh", "person"],
    "religions, en": ["muslims", "christians", "jews", "hindus", "buddhists", "catholics", "atheists", "sikhs", "people"],
    "gender, en": ["woman", "man", "girl", "boy", "transgender", "nonbinary", "person"],
    "genders, en": ["women", "men", "girls", "boys", "females", "males", "people"],
    "orientation, en": ["gay", "lesbian", "bisexual", "straight", "queer", "homosexual", "heterosexual", "person"],
    "origin, en": ["black", "white", "asian", "african", "european", "american", "latino", "arab", "mexican", "chinese", "indian", "foreign", "local"],
    "origins, en": ["immigrants", "refugees", "africans", "europeans", "americans", "latinos", "arabs", "mexicans", "foreigners", "people"],
    "condition, en": ["blind", "deaf", "disabled", "autistic", "elderly", "old", "young", "person"],
    "groups, de": ["muslime", "christen", "juden", "frauen", "männer", "schwule", "lesben", "ausländer", "flüchtlinge", "türken", "menschen"],
    "groups, fr": ["musulmans", "chrétiens", "juifs", "femmes", "hommes", "gays", "lesbiennes", "étrangers", "réfugiés", "arabes", "gens"],
    "groups, es": ["musulmanes", "cristianos", "judíos", "mujeres", "hombres", "gays", "lesbianas", "extranjeros", "refugiados", "gitanos", "gente"],
}

U = np.uint64
_SPREAD = U(0x9E3779B97F4A7C15)
_GAP = np.ones(256, bool)
_GAP[48:58] = _GAP[97:123] = _GAP[128:] = False


class Beginnings:
    """The words of a column of texts and their features: exact 64-bit keys of up to seven bytes and their number
    (8 added to it for a whole word)."""

    def __init__(self, col: pa.Array):
        if isinstance(col, pa.ChunkedArray):
            col = col.combine_chunks()
        lower = pc.utf8_lower(pc.fill_null(col, "").cast(pa.large_string()))
        data, bounds = text_bytes(pc.binary_join_element_wise(lower, pa.scalar("", pa.large_string()), pa.scalar("\n", pa.large_string())))
        gap = np.ones(len(data) + 1, bool)                        # every text ends in a line feed, so words end with it
        gap[1:] = _GAP[data]
        turn = np.flatnonzero(gap[1:] != gap[:-1])
        self.start, self.size = turn[::2], turn[1::2] - turn[::2]
        self.text = np.searchsorted(bounds, self.start, side="right") - 1
        self.n_words = np.bincount(self.text, minlength=len(col)) if len(self.text) else np.zeros(len(col), np.int64)
        self.data = np.append(data, np.zeros(LONGEST, np.uint8))

    def keys(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each kind of feature the words that have it, and its keys."""
        key = np.zeros(len(self.start), np.uint64)
        for n in range(1, LONGEST + 1):
            key = (key << U(8)) | self.data[self.start + n - 1]
            if n >= SHORTEST:
                there = np.flatnonzero(self.size >= n)
                yield there, key[there] | U(n << 56)
            whole = np.flatnonzero(self.size == n)
            yield whole, key[whole] | U(n + 8 << 56)


class Features:
    """A set of keys: finds the words that have one of them."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.sort(keys.astype(np.uint64))
        self.flag = np.zeros(1 << SLOT_BITS, bool)
        self.flag[(self.keys * _SPREAD) >> U(64 - SLOT_BITS)] = True

    def find(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each feature met, text by text, its text and its number; and each text's words."""
        words = Beginnings(col)
        texts, nos = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        if len(self.keys):
            for at, key in words.keys():
                near = np.flatnonzero(self.flag[(key * _SPREAD) >> U(64 - SLOT_BITS)])
                at, key = at[near], key[near]
                no = np.searchsorted(self.keys, key)
                hit = self.keys[np.minimum(no, len(self.keys) - 1)] == key
                texts.append(words.text[at[hit]])
                nos.append(no[hit])
        text, no = np.concatenate(texts), np.concatenate(nos)
        order = np.argsort(text, kind="stable")
        return text[order], no[order], words.n_words


def probability(logit: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return 1 / (1 + np.exp(-logit))


def rate(n_words: np.ndarray) -> np.ndarray:
    """What one word counts in texts of so many."""
    return PER / (n_words + ADDED)


@dataclass
class Model:
    """Feature keys (ascending), their weights, and the bias (minus infinity: nothing was taught)."""

    keys: np.ndarray
    weights: np.ndarray
    bias: float

    def evidence(self, word: str) -> float:
        """The sum of a word's weights."""
        _, no, _ = Features(self.keys).find(pa.array([word]))
        return float(self.weights[no].sum())


@tidy
def _count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            toxic = part.column("toxic").to_numpy().astype(bool)
            words = Beginnings(part.column("text"))
            for at, key in words.keys():
                if not len(at):
                    continue
                text = words.text[at]
                order = np.lexsort((text, key))
                key, text = key[order], text[order]
                first = np.append(True, (key[1:] != key[:-1]) | (text[1:] != text[:-1]))
                key, text = key[first], text[first]
                cut = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
                yes = np.add.reduceat(toxic[text].astype(np.int64), cut)
                n = np.diff(np.append(cut, len(key)))
                yield pa.RecordBatch.from_arrays([pa.array(key[cut].view(np.int64)), pa.array(yes), pa.array(n - yes)], names=["key", "yes", "no"])


def labelled_sample(docs: DataFrame, labels: DataFrame, per_label: int = TRAIN_DOCS, id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "toxic") -> tuple[DataFrame, dict[int, tuple[int, float]]]:
    """``(text, toxic)`` of about ``per_label`` labelled rows of each label that are not held out, and for each label
    how many rows have it and the share drawn.  Of several labels of one id 1 counts; null ids and labels teach nothing."""
    known = labels.where(~held_out(id_col)).groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("toxic")) \
        .where("id IS NOT NULL AND toxic IN (0, 1)")
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    drawn = {k: (n, min(1.0, per_label / n)) for k, n in counts.items()}
    share = F.when(F.col("toxic") == 1, drawn.get(1, (0, 0.0))[1]).otherwise(drawn.get(0, (0, 0.0))[1])
    chosen = written(known.where(F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(1 << 20)) / (1 << 20) < share), "chosen")
    # about 2 x per_label rows of two numbers, whatever the table's size
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id").where("text IS NOT NULL")
    return written(rows.select("text", "toxic"), "taught"), drawn


def mentions(texts: DataFrame, terms: dict[str, list[str]]) -> dict[str, tuple[int, float]]:
    """For each identity term how often it stands in a sentence of the texts, and the sum of ``rate`` squared of those sentences."""
    listed = "|".join(re.escape(w) for w in sorted({w for group in terms.values() for w in group}))
    pattern = r"(?<![\p{L}\p{N}])(" + listed + r")(?![\p{L}\p{N}])"
    sentences = texts.select(F.explode(F.split(F.lower("text"), r"[.!?\r\n]+")).alias("sentence")).where(F.col("sentence").rlike(pattern))
    n = F.size(F.regexp_extract_all("sentence", F.lit(r"([\p{L}\p{N}]+)"), F.lit(1)))
    found = sentences.select(F.explode(F.regexp_extract_all("sentence", F.lit(pattern), F.lit(1))).alias("term"), F.pow(PER / (n + ADDED), F.lit(2.0)).alias("square"))
    return {r["term"]: (r["n"], r["s"]) for r in found.groupBy("term").agg(F.count("*").alias("n"), F.sum("square").alias("s")).collect()}


def swaps(keys: np.ndarray, terms: dict[str, list[str]], said: dict[str, tuple[int, float]]) -> tuple[np.ndarray, np.ndarray]:
    """For each ordered pair of terms of one kind the change of feature counts that a swap makes, and its weight: the
    squared rates of the first term's sentences, shared out over its kind's other terms, by all mentions."""
    features = Features(keys)
    rows, weight = [], []
    for group in terms.values():
        counts = np.zeros((len(group), len(keys)))
        text, no, _ = features.find(pa.array(group))
        np.add.at(counts, (text, no), 1)
        for i, term in enumerate(group):
            square = said.get(term, (0, 0.0))[1] + (PER / (20 + ADDED)) ** 2
            for j in range(len(group)):
                if i != j and (counts[i] != counts[j]).any():
                    rows.append(counts[j] - counts[i])
                    weight.append(square / (len(group) - 1))
    total = sum(1 + said.get(t, (0, 0.0))[0] for group in terms.values() for t in group)
    return np.array(rows).reshape(len(rows), len(keys)), np.array(weight) / max(total, 1)


def train(docs: DataFrame, labels: DataFrame, per_label: int = TRAIN_DOCS, features: int = FEATURES, rounds: int = ROUNDS, swap: float = SWAP,
          terms: dict[str, list[str]] | None = None, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """A model from the labelled rows that are not held out.  With one label alone there are no features, and the bias
    is that label's log odds (with half a row of each added); without any, every score is 0."""
    spark: SparkSession = docs.sparkSession
    terms = IDENTITY_TERMS if terms is None else terms
    sample, drawn = labelled_sample(docs, labels, per_label, id_col, text_col, label_col)
    n = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    none = np.zeros(0, np.uint64)
    if not n:
        return Model(none, np.zeros(0), -np.inf)
    odds = float(np.log((drawn.get(1, (0,))[0] + 0.5) / (drawn.get(0, (0,))[0] + 0.5)))
    if len(n) < 2:
        return Model(none, np.zeros(0), odds)
    yes, no = float(n[1]), float(n[0])
    seen = sample.mapInArrow(_count_features, "key long, yes long, no long").groupBy("key").agg(F.sum("yes").cast("double").alias("yes"), F.sum("no").cast("double").alias("no"))
    cells = [("yes", yes), ("no", no)]

    def part(have, of: float, all_have, all_of: float):
        return F.when(have > 0, have * F.log(have * all_of / (F.lit(of) * all_have))).otherwise(0.0)

    here = F.col("yes") + F.col("no")
    away = F.lit(yes + no) - here
    g = sum((part(F.col(c), of, here, yes + no) + part(F.lit(of) - F.col(c), of, away, yes + no) for c, of in cells), F.lit(0.0)) * 2
    best = (seen.where((F.col("yes") >= LEAST_TEXTS) & (F.col("yes") * no > F.col("no") * yes)).withColumn("g", g).where(F.col("g") >= LEAST_G)
            .orderBy(F.desc("g"), "key").limit(features).toArrow())
    keys = best["key"].to_numpy().view(np.uint64)
    order = np.argsort(keys)
    keys, a, c = keys[order], best["yes"].to_numpy()[order], best["no"].to_numpy()[order]
    change, share = swaps(keys, terms, mentions(sample, terms))
    rows = written(sample.repartition(partitions(spark)).mapInArrow(_taught(keys), "toxic int, n_words int, feature array<int>"), "features")
    weight = {k: (drawn[k][0] / n[k]) / sum(v[0] for v in drawn.values()) for k in n}          # as the labels stand in the whole table
    w, bias = 0.1 * np.log((a + 0.5) * (no + 1) / ((c + 0.5) * (yes + 1))), odds
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for step in range(1, rounds + 1):
        held = spark.sparkContext.broadcast((w, bias, weight))
        got = rows.mapInArrow(_gradient(held), "gradient binary").collect()
        held.destroy()
        grad = np.sum([np.frombuffer(r["gradient"]) for r in got], axis=0)
        grad[:-1] += RIDGE * w
        if len(change):
            grad[:-1] += swap * change.T @ (share * (change @ w)) * 2
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        move = RATE * (1 - (step - 1) / rounds) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
        w, bias = w - move[:-1], bias - float(move[-1])
    return Model(keys, w, bias)


def _taught(keys: np.ndarray):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(keys)
        for batch in batches:
            for some in slices(batch):
                text, no, n_words = features.find(some.column("text"))
                cut = pa.array(np.searchsorted(text, np.arange(len(some) + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays([some.column("toxic"), pa.array(n_words.astype(np.int32)),
                                                  pa.ListArray.from_arrays(cut, pa.array(no.astype(np.int32)))], names=["toxic", "n_words", "feature"])
    return run


def _gradient(held):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, bias, weight = held.value
        total = np.zeros(len(w) + 1)
        for batch in batches:
            lists = batch.column("feature")
            text = np.repeat(np.arange(len(batch)), pc.list_value_length(lists).to_numpy())
            no = lists.flatten().to_numpy()
            one = rate(batch.column("n_words").to_numpy())
            toxic = batch.column("toxic").to_numpy()
            off = (probability(bias + one * np.bincount(text, w[no], len(batch))) - toxic) * np.where(toxic == 1, weight[1], weight[0])
            total[-1] += off.sum()
            total[:-1] += np.bincount(no, (off * one)[text], len(w))
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["gradient"])
    return run


def score_texts(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, score)`` for each row: the model's probability of label 1, whole texts, rows not moved."""
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    held = docs.sparkSession.sparkContext.broadcast((model.keys, model.weights, model.bias))

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, weights, bias = held.value
        features = Features(keys)
        for batch in batches:
            for some in slices(batch):
                text, no, n_words = features.find(some.column("text"))
                logit = bias + rate(n_words) * np.bincount(text, weights[no], len(some))
                yield pa.RecordBatch.from_arrays([some.column("id"), pa.array(probability(logit))], names=["id", "score"])

    return base.mapInArrow(run, f"id {base.schema['id'].dataType.simpleString()}, score double").withColumnRenamed("id", id_col)


def score_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "toxic") -> DataFrame:
    """Trains on the labelled rows that are not held out and scores all: ``(id, held_out, score, predicted)``.

    Null, empty and wordless texts get the score of a text without evidence.  Repeated rows are rows of their own; a null id
    is not held out and has no label.  Texts of any length are scored whole.  Other columns are not read.  An empty
    table gives no rows."""
    model = train(docs, labels, id_col=id_col, text_col=text_col, label_col=label_col)
    out = score_texts(docs, model, id_col, text_col)
    return out.select(id_col, held_out(id_col).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
