"""Licence scans: mark-up templates compiled to token automata, and phrase mentions.

A template is parsed into mandatory words, optional parts and replaceable regions, and compiled to an
automaton without empty moves: its states are the template's words and region places, and a bit mask per
state holds what may follow.  A text is accepted where a run of its words fits the mandatory wording exactly.
Only texts that hold a template's or phrase's rarest word are looked at word by word.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.decontaminate import NOT_WORD
from quarry.llm.license_templates import PHRASES, TEMPLATES
from quarry.llm.words import Words, slices, tidy

_MARK = re.compile(r"\[\[|\]\]|\{\{(\d+),(\d+)\}\}|[^\s\[\]{}]+")
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def ascii_lower(text: str) -> str:
    return text.translate(_LOWER)


_LOWER = {c: c + 32 for c in range(65, 91)}


def parse(markup: str) -> list:
    """Nested parts: a word, ``("any", a, b)`` or ``("optional", parts)``."""
    stack: list[list] = [[]]
    for m in _MARK.finditer(ascii_lower(markup)):
        if m[0] == "[[":
            stack.append([])
        elif m[0] == "]]":
            if len(stack) < 2:
                raise ValueError("an optional part ends that has not begun")
            part = ("optional", stack.pop())
            stack[-1].append(part)
        elif m[1] is not None:
            if int(m[1]) > int(m[2]):
                raise ValueError(f"an empty range {m[0]}")
            stack[-1].append(("any", int(m[1]), int(m[2])))
        else:
            stack[-1].extend(_WORD.findall(m[0]))
    if len(stack) > 1:
        raise ValueError("an optional part does not end")
    return stack[0]


class Automaton:
    """States are template places: ``follow[s]`` are the bits of the places that may come next."""

    def __init__(self, markup: str):
        self.words: list[str | None] = []          # None: any word
        self.follow: list[int] = []
        self.first, self.last, empty = self._sequence(parse(markup))
        if empty or not self.first or any(self.words[s] is None for s in _bits(self.first)):
            raise ValueError("a template begins with mandatory or optional words and is not empty")
        self.openers = {self.words[s] for s in _bits(self.first)}

    def _place(self, word: str | None) -> int:
        self.words.append(word)
        self.follow.append(0)
        return 1 << (len(self.words) - 1)

    def _sequence(self, parts: list) -> tuple[int, int, bool]:
        """Bits of the first and last places, and whether the parts may be empty."""
        first, last, empty = 0, 0, True
        for part in parts:
            if isinstance(part, str):
                f = own = self._place(part)
                skip = False
            elif part[0] == "optional":
                f, own, _ = self._sequence(part[1])
                skip = True
            else:
                places = [self._place(None) for _ in range(part[2])]
                for a, b in zip(places, places[1:], strict=False):
                    self.follow[a.bit_length() - 1] |= b
                f = places[0] if places else 0
                own = sum(p for i, p in enumerate(places, 1) if i >= part[1])
                skip = part[1] == 0
            for s in _bits(last):
                self.follow[s] |= f
            first |= f if empty else 0
            last = own | (last if skip else 0)
            empty = empty and skip
        return first, last, empty

    def accept(self, tokens: list[str], start: int) -> int:
        """End of the longest run of tokens from start that fits, or -1."""
        words, follow, live, end = self.words, self.follow, self.first, -1
        for i in range(start, len(tokens)):
            hit = nxt = 0
            for s in _bits(live):
                if words[s] is None or words[s] == tokens[i]:
                    hit |= 1 << s
                    nxt |= follow[s]
            if not hit:
                break
            if hit & self.last:
                end = i + 1
            live = nxt
        return end


def _bits(mask: int) -> Iterator[int]:
    while mask:
        low = mask & -mask
        yield low.bit_length() - 1
        mask ^= low


def template_regex(markup: str) -> str:
    """The template as a regular expression over words that are each followed by a space."""
    def build(parts: list) -> str:
        out = ""
        for part in parts:
            if isinstance(part, str):
                out += re.escape(part) + " "
            elif part[0] == "optional":
                out += f"(?:{build(part[1])})?"
            else:
                out += f"(?:[^ ]+ ){{{part[1]},{part[2]}}}"
        return out
    return build(parse(markup))


class Scanner:
    def __init__(self, templates: dict[str, str], phrases: dict[str, str]):
        self.automata = {label: Automaton(m) for label, m in templates.items()}
        self.phrases = [(tuple(_WORD.findall(ascii_lower(p))), label) for p, label in phrases.items()]
        openers = {w for a in self.automata.values() for w in a.openers} | {p[0] for p, _ in self.phrases}
        # Each phrase and template has a mandatory word by which texts of interest are found.
        keys = sorted({p[-1] for p, _ in self.phrases} | {self._rare(m) for m in templates.values()})
        self.keys = Words(pa.array([" ".join(keys)], pa.large_string()), is_gap=NOT_WORD).hash
        self.openers = openers

    @staticmethod
    def _rare(markup: str) -> str:
        """The longest mandatory word."""
        return max((p for p in parse(markup) if isinstance(p, str)), key=len)

    def scan(self, tokens: list[str]) -> tuple[list[tuple[int, str]], list[tuple[str, int, int]]]:
        """Phrase mentions (start, label) and accepted templates (label, start, end)."""
        mentions, accepted = [], []
        for i, word in enumerate(tokens):
            if word not in self.openers:
                continue
            for phrase, label in self.phrases:
                if phrase[0] == word and tuple(tokens[i:i + len(phrase)]) == phrase:
                    mentions.append((i, label))
            for label, automaton in self.automata.items():
                if word in automaton.openers and (end := automaton.accept(tokens, i)) > 0:
                    accepted.append((label, i, end))
        return mentions, accepted

    def run(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                words = Words(part.column("text"), lower=True, is_gap=NOT_WORD)
                hit = np.zeros(len(words), bool)
                for key in self.keys:
                    hit |= words.hash == key
                docs = set((np.searchsorted(words.row, np.flatnonzero(hit), side="right") - 1).tolist())
                raw = words.data.tobytes() if docs else b""
                base, first, last, base_labels, labels, score, spans = [], [], [], [], [], [], []
                for i in range(len(part)):
                    mentions, accepted = [], []
                    if i in docs:
                        lo, hi = words.row[i], words.row[i + 1]
                        tokens = [raw[a:b].decode() for a, b in zip(words.start[lo:hi].tolist(), words.end[lo:hi].tolist(), strict=True)]
                        mentions, accepted = self.scan(tokens)
                    own = {x for _, x in mentions}
                    base.append(len(mentions))
                    first.append(mentions[0][0] if mentions else None)
                    last.append(mentions[-1][0] if mentions else None)
                    base_labels.append(",".join(sorted(own)))
                    labels.append(",".join(sorted(own | {x for x, _, _ in accepted})))
                    score.append(1.0 if accepted else 0.5 if mentions else 0.0)
                    spans.append([{"label": x, "first": a, "end": b} for x, a, b in accepted])
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(words.n_words().astype(np.int64)), pa.array(base, pa.int64()), pa.array(first, pa.int64()),
                     pa.array(last, pa.int64()), pa.array(base_labels, pa.string()), pa.array(labels, pa.string()), pa.array(score, pa.float64()),
                     pa.array(spans, pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("end", pa.int64())])))],
                    names=["id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"])


def scan_licenses(docs: DataFrame, templates: dict[str, str] = TEMPLATES, phrases: dict[str, str] = PHRASES,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``n_words``, ``n_base`` phrase mentions, ``first_word`` and
    ``last_word`` (their least and greatest start), ``base_labels``, ``labels`` (with those of accepted
    templates), ``score`` (1 if a template is accepted, 0.5 if only a phrase stands there, else 0) and
    ``spans`` (label, first word, end of each accepted run).

    A null or empty text has no words.  Of runs from one start the longest counts; runs may overlap.  Repeated
    rows are rows of their own; the whole text is scanned; rows are not moved."""
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = base.schema["id"].dataType.simpleString()

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return Scanner(templates, phrases).run(batches)

    return base.mapInArrow(run, f"id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, "
                           "labels string, score double, spans array<struct<label:string, first:long, end:long>>").withColumnRenamed("id", id_col)
