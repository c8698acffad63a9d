"""Language identification by unigram piece models that sum over all segmentations.

The pieces are a fixed public vocabulary.  Each language has a probability per piece, learnt by expectation
maximisation from word counts of labelled texts; the probability of a word is the sum, over all ways to cut
it into pieces, of the products of their probabilities (forward algorithm), and that of a text the product
over its words.  Words are letter runs of the lower-cased text, marked at their start, so pieces never cross
white space and each distinct word of a batch is scored once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import written
from quarry.llm.words import slices, text_bytes, tidy

#: Labelled texts per language that training reads, about (a hash picks them), and rounds of training.
TRAIN_DOCS = 2000
ROUNDS = 3
#: Probability of a character that is no piece, in every language; added count of every piece.
UNKNOWN = 1e-7
ADDED = 0.05
#: Word scores a task keeps between batches.
KEPT_WORDS = 200_000
#: Text bytes scored at once (a longer text alone).
PREDICT_BYTES = 2 << 20
UNDETERMINED = "und"

_START = "▁"
_GAP = np.arange(256, dtype=np.uint8)
_GAP[[b for b in range(0x80) if not chr(b).isalpha()]] = 0x20


def pieces(vocabulary: str | None = None) -> list[str]:
    """The vocabulary's pieces in rank order (a sentencepiece model file; by default the public 32k one)."""
    import sentencepiece
    if vocabulary is None:
        import public_tokenizers
        vocabulary = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=vocabulary)
    return [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i))]


def words_of(col: pa.Array) -> pa.ListArray:
    """Each text's letter runs, lower-cased (null: none)."""
    data, bounds = text_bytes(pc.utf8_lower(col.cast(pa.large_string())))
    clean = pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(np.ascontiguousarray(bounds, np.int64)), pa.py_buffer(_GAP[data]))
    split = pc.ascii_split_whitespace(clean)
    flat = split.values.slice(split.offsets[0].as_py(), split.offsets[-1].as_py() - split.offsets[0].as_py())
    full = pc.not_equal(pc.binary_length(flat), 0)
    if len(flat) and not pc.all(full).as_py():
        counts = np.append(0, np.cumsum(full.to_numpy(zero_copy_only=False)))
        offsets = split.offsets.to_numpy() - split.offsets[0].as_py()
        return pa.ListArray.from_arrays(pa.array(counts[offsets].astype(np.int32)), flat.filter(full))
    return split


class Pieces:
    """The vocabulary's pieces by length, as sorted polynomial hashes of their characters; a bit table in front
    of each keeps most substrings from the search."""

    BASE = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, vocabulary: list[str]):
        self.vocabulary = vocabulary
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        found: dict[int, list[tuple[int, int]]] = {}
        for i, text in enumerate(vocabulary):
            h = 0
            for c in map(ord, text):
                h = (h * int(self.BASE) + c + 1) % (1 << 64)
            found.setdefault(len(text), []).append((h, i))
        for n, rows in found.items():
            rows.sort()
            keys = np.array([h for h, _ in rows], np.uint64)
            front = np.zeros(1 << 16, bool)
            front[(keys >> np.uint64(48)).astype(np.int64)] = True
            self.by_length[n] = keys, np.array([i for _, i in rows], np.int64), front

    def edges(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(word, from, to, piece) of every piece in the marked words; piece -1 for a character that is none."""
        codes = np.frombuffer(("".join(_START + w for w in words)).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
        size = np.array([len(w) + 1 for w in words], np.int64)
        word = np.repeat(np.arange(len(words)), size)
        place = np.arange(len(codes)) - np.repeat(np.cumsum(size) - size, size)
        room = np.repeat(size, size) - place
        out: list[tuple[np.ndarray, ...]] = []
        at = np.arange(len(codes))
        h = np.zeros(len(codes), np.uint64)
        for n in range(1, max(self.by_length, default=1) + 1):
            fits = room[at] >= n
            at, h = at[fits], h[fits] * self.BASE + codes[at[fits] + n - 1]
            if not len(at):
                break
            keys, index, front = self.by_length.get(n, (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(1 << 16, bool)))
            hit = np.flatnonzero(front[(h >> np.uint64(48)).astype(np.int64)])
            slot = np.minimum(np.searchsorted(keys, h[hit]), max(len(keys) - 1, 0))
            ok = keys[slot] == h[hit] if len(keys) else np.zeros(0, bool)
            hit, piece = hit[ok], index[slot[ok]] if len(keys) else np.zeros(0, np.int64)
            if n == 1:
                whole = np.full(len(at), -1, np.int64)
                whole[hit] = piece
                hit, piece = np.arange(len(at)), whole
            own = at[hit]
            out.append((word[own], place[own], place[own] + n, piece))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 4


class Lattice:
    """The pieces inside a list of words: edges (word, from, to, piece), piece -1 for an unknown character."""

    def __init__(self, words: list[str], pieces: Pieces):
        self.n = len(words)
        self.ends = np.array([len(x) + 1 for x in words], np.int64)
        self.word, self.lo, self.hi, self.piece = pieces.edges(words)
        self.order = np.argsort(self.hi, kind="stable")
        self.cuts = np.searchsorted(self.hi[self.order], np.arange(int(self.ends.max(initial=0)) + 2))

    def forward(self, prob: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scaled forward sums (word, place, language) and the log scale of each place, for probabilities
        (piece + 1, language), the last row for unknown characters."""
        size, langs = len(self.cuts) - 1, prob.shape[1]
        alpha = np.zeros((self.n, size, langs))
        scale = np.zeros((self.n, size, langs))
        alpha[:, 0] = 1
        for e in range(1, size):
            own = self.order[self.cuts[e]:self.cuts[e + 1]]
            w, a = self.word[own], self.lo[own]
            now = scale[:, e - 1]
            step = alpha[w, a] * prob[self.piece[own]] * np.exp(scale[w, a] - now[w])
            at = np.zeros((self.n, langs))
            np.add.at(at, w, step)
            small = (at > 0) & (at < 1e-100)
            scale[:, e] = now + np.where(small, np.log(np.where(small, at, 1)), 0)
            alpha[:, e] = np.where(small, 1, at)
        return alpha, scale

    def score(self, prob: np.ndarray) -> np.ndarray:
        """Log probability of each word in each language."""
        if not self.n:
            return np.zeros((0, prob.shape[1]))
        alpha, scale = self.forward(prob)
        row = np.arange(self.n)
        return np.log(alpha[row, self.ends]) + scale[row, self.ends]

    def expected(self, prob: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Expected uses of each piece in each language, words weighted by weight (word, language)."""
        alpha, scale = self.forward(prob)
        size, langs = alpha.shape[1], prob.shape[1]
        row = np.arange(self.n)
        beta, down = np.zeros_like(alpha), np.zeros_like(scale)
        beta[row, self.ends] = 1
        back = np.argsort(-self.lo, kind="stable")
        lows = -self.lo[back]
        for a in range(size - 2, -1, -1):
            own = back[np.searchsorted(lows, -a, side="left"):np.searchsorted(lows, -a, side="right")]
            w, e = self.word[own], self.hi[own]
            now = down[:, a + 1]
            at = np.zeros((self.n, langs))
            np.add.at(at, w, beta[w, e] * prob[self.piece[own]] * np.exp(down[w, e] - now[w]))
            at = np.where(self.ends[:, None] == a, 1, at)
            small = (at > 0) & (at < 1e-100)
            down[:, a] = now + np.where(small, np.log(np.where(small, at, 1)), 0)
            beta[:, a] = np.where(small, 1, at)
        total = np.log(alpha[row, self.ends]) + scale[row, self.ends]
        w = self.word
        used = alpha[w, self.lo] * beta[w, self.hi] * prob[self.piece] * np.exp(scale[w, self.lo] + down[w, self.hi] - total[w]) * weight[w]
        out = np.zeros_like(prob)
        np.add.at(out, self.piece, used)
        return out


def word_scores(words: list[str], prob: np.ndarray, pieces: Pieces) -> np.ndarray:
    """Log probabilities (word, language); words of like length are handled together, in bounded groups."""
    out = np.zeros((len(words), prob.shape[1]))
    order = sorted(range(len(words)), key=lambda i: len(words[i]))
    at = 0
    while at < len(order):
        to = min(len(order), at + max(1, 60_000 // (len(words[order[at]]) + 4)))
        while to > at + 1 and len(words[order[to - 1]]) > 2 * len(words[order[at]]) + 8:
            to = (at + to + 1) // 2
        own = order[at:to]
        out[own] = Lattice([words[i] for i in own], pieces).score(prob)
        at = to
    return out


class Model:
    """Languages, pieces and their probabilities; scores batches of texts."""

    def __init__(self, langs: list[str], vocabulary: list[str], prob: np.ndarray):
        self.langs, self.prob = langs, prob
        self.pieces = Pieces(vocabulary)
        self.known: dict[str, int] = {}                         # rows of kept
        self.kept = np.zeros((KEPT_WORDS if langs else 0, len(langs)))

    def predict(self, col: pa.Array) -> tuple[list[str], np.ndarray]:
        """Each text's language and the language's posterior under equal priors."""
        words = words_of(col)
        n = len(words)
        has = np.zeros(n, bool)
        log = np.zeros((n, len(self.langs)))
        if len(words.values) and self.langs:
            coded = words.flatten().dictionary_encode()
            names = coded.dictionary.to_pylist()
            row = np.fromiter((self.known.get(w, -1) for w in names), np.int64, len(names))
            score = np.where((row >= 0)[:, None], self.kept[row], 0.0)
            new = np.flatnonzero(row < 0).tolist()
            score[new] = word_scores([names[i] for i in new], self.prob, self.pieces)
            have = len(self.known)
            new = new[:KEPT_WORDS - have]
            self.kept[have:have + len(new)] = score[new]
            self.known.update((names[i], have + j) for j, i in enumerate(new))
            offsets = words.offsets.to_numpy().astype(np.int64)
            offsets -= offsets[0]
            sums = np.zeros((len(coded) + 1, len(self.langs)))
            np.cumsum(score[coded.indices.to_numpy()], axis=0, out=sums[1:])
            log = sums[offsets[1:]] - sums[offsets[:-1]]
            has = offsets[1:] > offsets[:-1]
        if has.any():                      # words of other characters alone may hold no letter
            ascii_letter = pc.fill_null(pc.match_substring_regex(col, "[A-Za-z]"), False).to_numpy(zero_copy_only=False)
            for i in np.flatnonzero(has & ~ascii_letter).tolist():
                has[i] = any(ch.isalpha() for ch in col[i].as_py())
        if not self.langs:
            return [UNDETERMINED] * n, np.zeros(n)
        best = log.argmax(axis=1)
        share = 1 / np.exp(log - log.max(axis=1, keepdims=True)).sum(axis=1)
        return [self.langs[b] if h else UNDETERMINED for b, h in zip(best.tolist(), has.tolist(), strict=True)], np.where(has, share, 0.0)


@tidy
def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            words = words_of(part.column("text"))
            lang = part.column("lang").take(pc.list_parent_indices(words))
            got = pa.table({"lang": lang, "word": words.flatten()}).group_by(["lang", "word"]).aggregate([([], "count_all")])
            for b in got.select(["lang", "word", "count_all"]).rename_columns(["lang", "word", "n"]).cast(
                    pa.schema([("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())])).combine_chunks().to_batches():
                yield b


def train(labelled: DataFrame, vocabulary: list[str] | None = None, docs_per_lang: int = TRAIN_DOCS, rounds: int = ROUNDS,
          id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """A model from the rows with text and label.

    At most about ``docs_per_lang`` texts of each label are read (those whose id's hash is low; the rate comes
    from the label's count).  Each round's expected counts are summed by Spark; what reaches the driver is
    languages x pieces numbers."""
    spark: SparkSession = labelled.sparkSession
    vocabulary = pieces() if vocabulary is None else vocabulary
    rows = labelled.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")) \
        .where("text is not null and lang is not null")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(counts)
    if not langs:
        return Model([], vocabulary, np.zeros((len(vocabulary) + 1, 0)))
    share = F.create_map(*[F.lit(x) for k in langs for x in (k, min(1.0, docs_per_lang / counts[k]))])[F.col("lang")]
    sample = rows.where((F.pmod(F.xxhash64("id"), F.lit(1 << 20)) / (1 << 20)) < share)
    words = written(sample.select("text", "lang").mapInArrow(_count_words, "lang string, word string, n long")
                    .groupBy("word", "lang").agg(F.sum("n").alias("n")), "words")
    size = len(vocabulary)
    prior = 1 / (np.arange(size) + 100.0)
    prob = np.repeat((prior / prior.sum())[:, None], len(langs), axis=1)
    prob = np.vstack([prob, np.full((1, len(langs)), UNKNOWN)])
    for _ in range(rounds):
        held = spark.sparkContext.broadcast((langs, vocabulary, prob))

        @tidy
        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            langs, vocabulary, prob = held.value
            at = {x: i for i, x in enumerate(langs)}
            known = Pieces(vocabulary)
            total = np.zeros_like(prob)
            for batch in batches:
                for lo in range(0, len(batch), 2000):
                    part = batch.slice(lo, 2000)
                    names = part.column("word").to_pylist()
                    order = sorted(range(len(names)), key=lambda i: len(names[i]))
                    lang, n = part.column("lang").to_pylist(), part.column("n").to_pylist()
                    for g in range(0, len(order), 500):
                        own = order[g:g + 500]
                        weight = np.zeros((len(own), len(langs)))
                        for j, i in enumerate(own):
                            weight[j, at[lang[i]]] = n[i]
                        total += Lattice([names[i] for i in own], known).expected(prob, weight)
            p, k = np.nonzero(total[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(p.astype(np.int32)), pa.array(k.astype(np.int32)), pa.array(total[p, k])], names=["piece", "lang", "uses"])

        uses = words.mapInArrow(run, "piece int, lang int, uses double").groupBy("piece", "lang").agg(F.sum("uses").alias("uses")).toArrow()
        new = np.full((size, len(langs)), ADDED)
        new[uses["piece"].to_numpy(), uses["lang"].to_numpy()] += uses["uses"].to_numpy()
        prob = np.vstack([new / new.sum(axis=0), np.full((1, len(langs)), UNKNOWN)])
    return Model(langs, vocabulary, prob)


def predict_languages(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, lang_pred, score)`` per row; ``und`` with score 0 where text is null or holds no letter."""
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    held = docs.sparkSession.sparkContext.broadcast((model.langs, model.pieces.vocabulary, model.prob))

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*held.value)
        for batch in batches:
            for part in slices(batch, size=PREDICT_BYTES):
                lang, score = own.predict(part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(lang, pa.string()), pa.array(score)], names=["id", "lang_pred", "score"])

    return base.mapInArrow(run, f"id {base.schema['id'].dataType.simpleString()}, lang_pred string, score double").withColumnRenamed("id", id_col)


def keep_identified(docs: DataFrame, model: Model, min_score: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows, all columns, whose language is determined with at least ``min_score``; rows are not moved.
    The score compares the taught languages with each other and goes to 1 within some ten words of any text, so in
    practice what goes is null or holds no letter."""
    held = docs.sparkSession.sparkContext.broadcast((model.langs, model.pieces.vocabulary, model.prob))

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*held.value)
        for batch in batches:
            for part in slices(batch, text_col, PREDICT_BYTES):
                lang, score = own.predict(part.column(text_col))
                yield part.filter(pa.array((np.array(lang) != UNDETERMINED) & (score >= min_score)))

    return docs.mapInArrow(run, docs.schema)


def training_rows(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The documents that may teach: those not held out."""
    return docs.where(~held_out(id_col))


def held_out(id_col: str = "doc_id"):
    """Whether crc32 of the id as text leaves remainder 2 by 4 (a null id: not)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def identify_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Trains on the rows that are not held out and predicts all rows: ``(id, held_out, lang_pred, score)``.

    Null, empty and letterless texts are ``und`` with score 0; so is all if no row is labelled.  Repeated rows
    are rows of their own.  Equal scores: the first label in order.  No text is cut, whatever its length."""
    model = train(training_rows(docs, id_col), id_col=id_col, text_col=text_col, lang_col=lang_col)
    out = predict_languages(docs, model, id_col, text_col)
    return out.select(id_col, held_out(id_col).alias("held_out"), "lang_pred", "score")
