"""Plain versions of the text operators, straight from their definitions."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

WORD = re.compile("[^\x20\x09-\x0d]+")


def joined(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def quality(text):
    words = WORD.findall(text or "")
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {i + j for i, w in enumerate(zip(words, words[1:], words[2:], strict=False)) if windows[w] > 1 for j in range(3)}
    lines, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in lines
            lines.add(line)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text or "")), dup, len(covered), failed


def luhn(number):
    total = 0
    for i, d in enumerate(map(int, reversed(number))):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def plain(text, kinds):
    return [(kind, *m.span()) for kind, form, holds in kinds for m in re.finditer(form, text or "") if holds(m)]


def private(text):
    """Base spans by kind, then start."""
    bare = lambda m: re.sub("[^0-9]", "", m[0])
    return plain(text, [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: max(map(int, m[0].split("."))) <= 255),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(bare(m)) <= 19 and luhn(bare(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(bare(m)) <= 15),
    ])


def secrets(text):
    """Base spans by start, then kind."""
    kinds = [
        ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), lambda m: len(m[2]) >= 6),
        ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
        ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 24),
    ]
    order = [k for k, _, _ in kinds]
    found = [(kind, *m.span()) for kind, form, holds in kinds for m in form.finditer(text or "") if holds(m)]
    return sorted(found, key=lambda s: (s[1], order.index(s[0])))


def shingles(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def near(texts: dict):
    """doc_id: (set size, smallest id reachable)."""
    sets = {d: shingles(t) for d, t in texts.items()}
    where = {}
    for d, s in sets.items():
        for x in s:
            where.setdefault(x, []).append(d)
    shared = Counter()
    for ids in where.values():
        shared.update((a, b) for i, a in enumerate(ids) for b in ids[i + 1 :])
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for (a, b), n in shared.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return {d: (len(s), find(d)) for d, s in sets.items()}


def repeats(texts: dict, width: int = 100):
    """doc_id: (bytes, removed, runs, sha256 of the rest)."""
    seen, out = set(), {}
    for d in sorted(texts):
        raw = (texts[d] or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - width + 1):
            piece = raw[i : i + width]
            if piece in seen:
                gone[i : i + width] = b"\x01" * width
            else:
                seen.add(piece)
        runs = len(re.findall(b"\x01+", bytes(gone)))
        rest = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        out[d] = (len(raw), sum(gone), runs, hashlib.sha256(rest).hexdigest())
    return out


def line_dedup(texts: dict, width: int = 8, similarity: float = 0.85, shortest: int = 1):
    """doc_id: text without the lines that are like an earlier one, or linked with one that is."""
    norm = {(d, i): x for d, t in texts.items() for i, raw in enumerate((t or "").split("\n")) if len(x := raw.strip(" ").lower()) >= shortest}
    first: dict[str, tuple] = {}
    for place in sorted(norm):
        first.setdefault(norm[place], place)
    sets = {p: {x[i : i + width] for i in range(len(x) - width + 1)} for x, p in first.items()}
    root = {p: p for p in sets}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    places = sorted(sets, key=lambda p: len(sets[p]))
    for i, a in enumerate(places):
        for b in places[i + 1 :]:
            x, y = sets[a], sets[b]
            if len(x) < similarity * len(y):
                break
            if not x:
                continue  # without shingles only equal lines are repeats, and those are one place already
            shared = len(x & y)
            if shared >= similarity * (len(x) + len(y) - shared):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    out = {}
    for d, t in texts.items():
        rows = (t or "").split("\n")
        out[d] = None if t is None else "\n".join(r for i, r in enumerate(rows) if (d, i) not in norm or find(first[norm[d, i]]) == (d, i))
    return out


TERM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def term_list(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def hard_negatives(rows, positives=5, negatives=10, low=30, high=90, scale=256):
    """``rows`` are (id, label, vector, whether an anchor); the answer as sorted tuples in the order of the columns."""
    fine = [(i, r[0], r[1], [math.floor(scale * x) for x in r[2]], r[3]) for i, r in enumerate(rows) if r[1] is not None and r[2] is not None and all(x is not None and math.isfinite(x) for x in r[2])]
    rank = lambda s: (-s[0], s[1] is None, s[1] or 0)
    out = []
    for i, anchor, label, v, is_anchor in fine:
        if not is_anchor:
            continue
        scores = [(sum(a * b for a, b in zip(v, w, strict=False)), other, same == label) for j, other, same, w, _ in fine if j != i]
        for p, pid, _ in sorted((s for s in scores if s[2]), key=rank)[:positives]:
            window = sorted((s for s in scores if not s[2] and low * p <= 100 * s[0] <= high * p), key=rank)[:negatives]
            out += [(anchor, pid, n, nid, p, s) for n, (s, nid, _) in enumerate(window, 1)]
    return sorted(out, key=str)


def phrase_places(text, phrases):
    words = term_list(text)
    places = [(label, i) for label, phrase in phrases for said in [phrase.split()] for i in range(len(words)) if words[i : i + len(said)] == said]
    return len(words), places


def template_expression(template):
    """The template as one regular expression over words that are each followed by a blank."""
    out = []
    for piece in re.split(r"(\[\[|\]\]|\{\{.*?\}\})", template, flags=re.S):
        if piece == "[[":
            out.append("(?:")
        elif piece == "]]":
            out.append(")?")
        elif piece.startswith("{{") and ".." in piece:
            least, most = piece[2:-2].split("..")
            out.append(f"(?:[^ ]+ ){{{int(least)},{int(most)}}}")
        elif piece.startswith("{{"):
            out.append("(?:" + "|".join("".join(re.escape(w) + " " for w in term_list(x)) for x in piece[2:-2].split("|")) + ")")
        else:
            out += [re.escape(w) + " " for w in term_list(piece)]
    return re.compile("(?<![^ ])" + "".join(out))


def lexical(docs, items, k=50):
    """(item place, rank, doc id, score) over lists of (id, text)."""
    bags = [(d, Counter(term_list(t))) for d, t in docs]
    n_docs, length = sum(1 for _, b in bags if b), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for place, (_, text) in enumerate(items):
        scores = []
        for d, bag in bags:
            if not bag:
                continue
            m = 50 + (50 * sum(bag.values()) * n_docs) // length
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * bag[t]) // (1000 * bag[t] + 20 * m)) for t in set(term_list(text)) if bag[t])
            if s > 0:
                scores.append((-s, d is None, d or 0, d))
        out += [(place, n, d, -s) for n, (s, _, _, d) in enumerate(sorted(scores, key=lambda x: x[:3])[:k], 1)]
    return out


def tiling(item, text, shortest=4):
    """Tiles one after another: the longest common run of free tokens, the earliest in the item, then in the text."""
    free_item, free_text, tiles = [True] * len(item), [True] * len(text), []
    while True:
        best = (-shortest + 1, 0, 0)
        for p in range(len(item)):
            for t in range(len(text)):
                n = 0
                while p + n < len(item) and t + n < len(text) and item[p + n] == text[t + n] and free_item[p + n] and free_text[t + n]:
                    n += 1
                best = min(best, (-n, p, t))
        n, p, t = -best[0], best[1], best[2]
        if n < shortest:
            return tiles
        tiles.append((n, p, t))
        free_item[p : p + n] = free_text[t : t + n] = [False] * n


def contained(texts, items, coverage=0.5, shortest=4):
    """``{(doc, item): (tokens, tiles, covered)}``; texts of scripts with blanks only, items of ``shortest`` tokens or more."""
    out = {}
    words = {i: re.findall(r"\w+", t.lower()) for i, t in items.items()}
    for d, text in texts.items():
        tokens = re.findall(r"\w+", (text or "").lower())
        grams = set(zip(*(tokens[i:] for i in range(shortest)), strict=False))
        for i, item in words.items():
            if grams.isdisjoint(zip(*(item[k:] for k in range(shortest)), strict=False)):
                continue
            found = tiling(item, tokens, shortest)
            covered = sum(n for n, _, _ in found)
            if covered >= coverage * len(item):
                out[d, i] = (len(item), len(found), covered)
    return out
