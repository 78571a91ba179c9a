"""Plain single-process versions of the operators, straight from their definitions."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def substring(rows: list[tuple], window: int = 35) -> list[tuple]:
    seen: Counter = Counter()
    split = [(d, words(t)) for d, t in rows]
    for _, w in split:
        seen.update(tuple(w[i:i + window]) for i in range(len(w) - window + 1))
    out = []
    for d, w in split:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone[i:i + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((d, len(w), sum(gone), sha(kept)))
    return out


def shingle_set(text: str | None) -> frozenset:
    w = words((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4)))


def near(rows: list[tuple]) -> list[tuple]:
    sets = [(d, shingle_set(t)) for d, t in rows]
    where = defaultdict(list)
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, (_, s) in enumerate(sets):
        for t in s:
            where[t].append(i)
    for i, (_, s) in enumerate(sets):
        shared: Counter = Counter()
        for t in s:
            shared.update(j for j in where[t] if j < i)
        for j, n in shared.items():
            if 100 * n >= 80 * (len(s) + len(sets[j][1]) - n):
                root[find(i)] = find(j)
    least: dict[int, int] = {}
    for i, (d, _) in enumerate(sets):
        if d is not None:
            r = find(i)
            least[r] = min(least.get(r, d), d)
    return [(d, len(s), least.get(find(i)) if s else d) for i, (d, s) in enumerate(sets)]


def exact(rows: list[tuple]) -> list[tuple]:
    groups = defaultdict(list)
    norm = [(t or "").translate(LOWER) for _, t in rows]
    for (d, _), n in zip(rows, norm):
        groups[n].append(d)
    out = []
    for (d, _), n in zip(rows, norm):
        known = [x for x in groups[n] if x is not None]
        keep = max(known) if known else None
        out.append((d, keep, len(groups[n]), sha(n)))
    return out


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")


def secret_base(text: str | None) -> tuple[int, int, int, str]:
    text = text or ""
    a = [m.span() for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    k = [m.span() for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    h = [m.span() for m in HEX.finditer(text) if len(m[0]) >= 32]
    listed = sorted((s, i, e) for i, found in enumerate((a, k, h)) for s, e in found)
    names = ("assign", "access", "hex")
    return len(a), len(k), len(h), sha(",".join(f"{names[i]}:{s}:{e}" for s, i, e in listed))


def quality_base(text: str | None) -> tuple[int, int, int, int, int]:
    text = text or ""
    w = words(text)
    seen: set = set()
    dup = 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    count = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    twice = [False] * len(w)
    for i in range(len(w) - 4):
        if count[tuple(w[i:i + 5])] > 1:
            twice[i:i + 5] = [True] * 5
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, sum(twice)


def backoff(rows: list[tuple], order: int = 3, vocabulary: int = 1 << 16, cut: int = 1) -> list[tuple]:
    import math
    split = [words(t) for _, t in rows]
    count = Counter(x for w in split for x in w)
    total = sum(count.values())
    least = max(1, -(-total // (vocabulary - 1)))
    split = [[x if count[x] >= least else None for x in w] for w in split]
    table = {n: Counter(tuple(w[i:i + n]) for w in split for i in range(len(w) - n + 1)) for n in range(1, order + 1)}

    def log_s(history: tuple, word) -> float:
        if not history:
            return math.log(table[1][(word,)] / total)
        n = table[len(history) + 1][(*history, word)]
        if n >= cut:
            return math.log(n / table[len(history)][history])
        return math.log(0.4) + log_s(history[1:], word)

    out = []
    for (d, _), w in zip(rows, split):
        s = [log_s(tuple(w[max(0, i - order + 1):i]), x) for i, x in enumerate(w)]
        out.append((d, len(w), sum(s) / len(s) if s else None))
    return out


def packing_errors(rows: list[tuple], got: list[dict], path: str, capacity: int = 4096) -> list[str]:
    """What is wrong with a packing of (doc_id, text) rows; doc_ids are distinct."""
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(path)
    errors = []
    of = defaultdict(list)
    seq = defaultdict(list)
    for r in got:
        of[r["doc_id"]].append(r)
        seq[r["sequence_id"]].append(r)
    for d, t in rows:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
        at = 0
        for r in sorted(of.pop(d, []), key=lambda r: r["start"]):
            part = ids[at:at + r["length"]]
            crc = zlib.crc32(b"".join(i.to_bytes(4, "little") for i in part))
            if (r["start"], r["doc_tokens"], r["ids_crc32"]) != (at, len(ids), crc) or not part:
                errors.append(f"piece of {d}: {r}")
            at += r["length"]
        if at != len(ids):
            errors.append(f"document {d}: {at} of {len(ids)} ids")
    errors += [f"unknown document {d}" for d in of]
    for s, parts in seq.items():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            if r["offset"] != at:
                errors.append(f"sequence {s}: gap at {at}")
            at += r["length"]
        if at > capacity:
            errors.append(f"sequence {s}: {at} ids")
    return errors


def padding(got: list[dict], capacity: int = 4096) -> tuple[int, int]:
    """Padding and ids of a packing."""
    size: Counter = Counter()
    for r in got:
        size[r["sequence_id"]] += r["length"]
    return sum(0 if n & (n - 1) == 0 else capacity - n for n in size.values()), sum(size.values())
