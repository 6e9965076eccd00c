"""License scan by template markup.

A template is the wording of a license with regions marked: ``[[ ]]`` may be left out, ``{{m..n}}`` is replaced by m to
n words of any kind, ``{{a|b}}`` by one of the wordings. Regions may stand in optional ones. All other words are mandatory
and must follow one another as they are; case and punctuation don't count.

Each template is split at its longest run of mandatory words. One Aho-Corasick pass finds these runs in a text, and at
each the two token automata of what stands after and before the run are followed, forwards and backwards. Their states
are sets of places in the template and are made when first met. A place is accepted where both end in acceptance.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import ahocorasick
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.llm.license_templates import TEMPLATES
from creditloom.llm.terms import terms

#: Words that make a label without a template, wherever they stand one after another.
PHRASES = [("mit", "under the mit license"), ("apache-2", "apache license version 2"), ("cc-by-nc", "cc by nc")]
#: Texts whose spans are in memory at a time.
SLICE = 1024

MARKS = re.compile(r"(\[\[|\]\]|\{\{.*?\}\})", re.S)
#: A parsed template: words, ("any", least, most), ("either", wordings), ("optional", parts).
Part = bytes | tuple


def parsed(template: str) -> list[Part]:
    open_regions: list[list[Part]] = [[]]
    for piece in MARKS.split(template):
        if piece == "[[":
            open_regions.append([])
        elif piece == "]]":
            if len(open_regions) == 1:
                raise ValueError(f"]] without [[: {template[:60]}")
            inner = open_regions.pop()
            open_regions[-1].append(("optional", inner))
        elif piece.startswith("{{"):
            body = piece[2:-2]
            if count := re.fullmatch(r"\s*(\d+)\.\.(\d+)\s*", body):
                open_regions[-1].append(("any", int(count[1]), int(count[2])))
            else:
                open_regions[-1].append(("either", [terms(x.encode()) for x in body.split("|")]))
        else:
            open_regions[-1] += terms(piece.encode())
    if len(open_regions) > 1:
        raise ValueError(f"[[ without ]]: {template[:60]}")
    return open_regions[0]


def backwards(parts: Sequence[Part]) -> list[Part]:
    out: list[Part] = []
    for p in reversed(parts):
        if isinstance(p, tuple) and p[0] == "either":
            p = ("either", [w[::-1] for w in p[1]])
        elif isinstance(p, tuple) and p[0] == "optional":
            p = ("optional", backwards(p[1]))
        out.append(p)
    return out


@dataclass
class Automaton:
    """Token automaton of a part of a template; its deterministic states are made as they are met."""

    steps: list[dict[bytes | None, set[int]]] = field(default_factory=lambda: [{}])  # by word, None for any word
    skips: list[set[int]] = field(default_factory=lambda: [set()])
    end: int = 0
    start: frozenset[int] = frozenset()
    known: dict[frozenset[int], dict[bytes | None, frozenset[int]]] = field(default_factory=dict)
    words: set[bytes] = field(default_factory=set)

    def state(self) -> int:
        self.steps.append({})
        self.skips.append(set())
        return len(self.steps) - 1

    def step(self, at: int, word: bytes | None) -> int:
        after = self.state()
        self.steps[at].setdefault(word, set()).add(after)
        if word is not None:
            self.words.add(word)
        return after

    def add(self, at: int, parts: Sequence[Part]) -> int:
        for p in parts:
            if isinstance(p, bytes):
                at = self.step(at, p)
                continue
            after = self.state()
            if p[0] == "any":
                for n in range(p[2] + 1):
                    if n >= p[1]:
                        self.skips[at].add(after)
                    if n < p[2]:
                        at = self.step(at, None)
            else:
                for choice in p[1] if p[0] == "either" else [p[1], []]:
                    self.skips[self.add(at, choice)].add(after)
            at = after
        return at

    def closed(self, states: set[int]) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for s in self.skips[todo.pop()] - seen:
                seen.add(s)
                todo.append(s)
        return frozenset(seen)

    def next(self, states: frozenset[int], word: bytes) -> frozenset[int]:
        key = word if word in self.words else None
        row = self.known.setdefault(states, {})
        if key not in row:
            row[key] = self.closed({t for s in states for k in {key, None} for t in self.steps[s].get(k, ())})
        return row[key]

    def longest(self, words: Sequence[bytes], at: int, way: int) -> int | None:
        """Words taken by the longest accepted run from ``at`` on, forwards or backwards; ``None`` if none is accepted."""
        states, taken, best = self.start, 0, None
        while states:
            if self.end in states:
                best = taken
            place = at + way * taken
            if not 0 <= place < len(words):
                break
            states = self.next(states, words[place])
            taken += 1
        return best


def automaton(parts: Sequence[Part]) -> Automaton:
    out = Automaton()
    out.end = out.add(0, parts)
    out.start = out.closed({0})
    return out


@dataclass
class Template:
    label: str
    run: list[bytes]
    before: Automaton
    after: Automaton


def compiled(label: str, template: str) -> Template:
    """The template at its longest run of mandatory words outside all regions; it must have one."""
    parts = parsed(template)
    runs, at = [], 0
    while at < len(parts):
        end = at
        while end < len(parts) and isinstance(parts[end], bytes):
            end += 1
        if end > at:
            runs.append((sum(map(len, parts[at:end])), at, end))
        at = end + 1
    if not runs:
        raise ValueError(f"no mandatory word in the template of {label}")
    _, at, end = max(runs, key=lambda r: (r[0], -r[1]))
    return Template(label, parts[at:end], automaton(backwards(parts[:at])), automaton(parts[end:]))


class Scanner:
    """Phrases and templates, and one Aho-Corasick automaton over all their runs of words."""

    def __init__(self, templates: Sequence[tuple[str, str]], phrases: Sequence[tuple[str, str]]):
        self.templates = [compiled(*t) for t in templates]
        runs: dict[str, tuple[int, list[tuple[str, Template | None]]]] = {}
        for label, run, template in [*((p, terms(w.encode()), None) for p, w in phrases), *((t.label, t.run, t) for t in self.templates)]:
            key = b" ".join([b"", *run, b""]).decode("latin-1")  # one character for each byte
            runs.setdefault(key, (len(run), []))[1].append((label, template))
        self.finder = ahocorasick.Automaton()
        for key, found in runs.items():
            self.finder.add_word(key, found)
        self.finder.make_automaton()

    def places(self, words: Sequence[bytes]) -> Iterator[tuple[str, int, int, bool]]:
        """(label, first word, end, whether it is a phrase), by the end of the run."""
        if not words or not len(self.finder):
            return
        line = b" ".join([b"", *words, b""]).decode("latin-1")
        seen = read = 0
        for last, (length, holders) in self.finder.iter(line):
            seen += line.count(" ", read, last)
            read = last
            first = seen - length
            for label, template in holders:
                if template is None:
                    yield label, first, seen, True
                else:
                    after = template.after.longest(words, seen, 1)
                    before = None if after is None else template.before.longest(words, first - 1, -1)
                    if before is not None:
                        yield label, first - before, seen + after, False


SPAN = "struct<label:string,start:long,end:long,base:boolean>"


def scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: Sequence[tuple[str, str]] | None = None,
    phrases: Sequence[tuple[str, str]] | None = None,
) -> DataFrame:
    """``(id_col, n_words, spans, covered)``: spans by start, end and label, ``covered`` the words under any of them.

    ``templates`` and ``phrases`` are pairs of label and wording; the library's own where not given. Words count from 0
    and ``end`` is exclusive. Null and empty texts have no words; repeated rows and null ids give rows of their own; an
    empty table gives an empty result. Other columns are not read.
    """
    own = [(label, text) for label, _, text in TEMPLATES] if templates is None else list(templates)
    said = PHRASES if phrases is None else list(phrases)
    Scanner(own, said)  # a fault in the markup shows here

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(own, said)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                counts, found, covered = [], [], []
                for text in pc.cast(part.column(1), pa.binary()).to_pylist():
                    words = terms(text)
                    spans = sorted(set(scanner.places(words)), key=lambda s: (s[1], s[2], s[0], not s[3]))
                    under = reach = 0
                    for _, start, end, _ in spans:
                        under += max(0, end - max(start, reach))
                        reach = max(reach, end)
                    counts.append(len(words))
                    found.append([{"label": a, "start": b, "end": c, "base": d} for a, b, c, d in spans])
                    covered.append(under)
                span = pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])
                columns = [part.column(0), pa.array(counts, pa.int64()), pa.array(found, pa.list_(span)), pa.array(covered, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=[id_col, "n_words", "spans", "covered"])

    kind = docs.schema[id_col].dataType.simpleString()
    source = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(run, f"`{id_col}` {kind}, n_words long, spans array<{SPAN}>, covered long")
