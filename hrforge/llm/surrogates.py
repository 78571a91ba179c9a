"""PII surrogates: keyed, type-consistent replacements.

Detected: e-mail addresses, phone numbers, payment card numbers (Luhn), IPv4
addresses, and person names after a title (Latin, Greek and Cyrillic script). The
unit of replacement is an entity (kind, canonical form): an e-mail's local part and
domain, and a name's given name and surname, are entities of their own, so that a
surname that returns alone keeps its surrogate. A surrogate is a keyed function of
kind, canonical form and a try number: same length and character classes, same script,
same card issuer digit and valid check digit, same country code; names take the gender
of their title or of the known given name, shown by the ending.

Distinctness is checked over the whole corpus: the distinct entities are numbered try
0; one whose surrogate equals a real entity of its kind, or another entity's surrogate
(the smaller canonical form keeps it), goes to the next try, until none is left. Names
and addresses so short that all of their length may be real grow with the tries. Only
entities beyond try 0 need to be known when texts are rewritten. They are few; up to
``LOCAL`` of them are broadcast (the size is checked), else they are joined to the rows
that hold them.

A null text stays null and an empty one empty, with no entities. Equal rows get equal
texts. Empty table: empty result. Long texts are searched whole. Columns other than
``doc_id`` and ``text`` are not read. The key is a parameter: without it surrogates
can't be recomputed.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import zip_longest

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hrforge.llm.common import arrow_batches, share, table

#: Entities beyond try 0 that are broadcast at most (some 20 MB).
LOCAL = 200_000
TRIES = 64
# Titles with the gender they show, and a few common given names.
TITLES = {"mr": "m", "mister": "m", "herr": "m", "monsieur": "m", "señor": "m", "sr": "m", "г-н": "m", "господин": "m", "κύριος": "m",
          "mrs": "f", "ms": "f", "miss": "f", "frau": "f", "madame": "f", "mme": "f", "señora": "f", "sra": "f", "г-жа": "f", "госпожа": "f", "κυρία": "f",
          "dr": "", "prof": ""}
GIVEN = {"m": {"james", "john", "robert", "michael", "david", "peter", "thomas", "paul", "hans", "pierre", "jean", "carlos", "josé", "иван", "пётр", "γιώργος"},
         "f": {"mary", "anna", "maria", "linda", "susan", "sarah", "emma", "julia", "laura", "marie", "claire", "carmen", "ирина", "ольга", "ελένη"}}
_NAME = r"(?:[A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ]+|[Α-ΩΆΈΉΊΌΎΏ][α-ωάέήίόύώςϊϋ]+|[А-ЯЁ][а-яё]+)"
_ALONE = re.compile(rf"(?<!\w){_NAME}(?!\w)")
PATTERNS = [
    ("email", re.compile(r"(?<![\w.+-])([A-Za-z0-9][A-Za-z0-9._%+-]*)@([A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,})")),
    ("ip", re.compile(r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\w]|\.\d)", re.A)),
    ("card", re.compile(r"(?<![\d+])(?:\d[ -]?){12,18}\d(?!\d)", re.A)),
    ("phone", re.compile(r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\d)|(?<![\w+])\+\d{1,3}(?:[ .-]?\d{2,4}){3,4}(?!\d)", re.A)),
    ("person", re.compile(rf"(?<!\w)(?i:({'|'.join(map(re.escape, sorted(TITLES, key=len, reverse=True)))}))\.? +({_NAME})(?: +({_NAME}))?")),
]
_VOWELS = {"latin": "aeiou", "greek": "αειο", "cyrillic": "аеио"}
_CONSONANTS = {"latin": "bdfgklmnprstv", "greek": "βγδκλμνπρστ", "cyrillic": "бвгдклмнпрст"}
_ENDING = {("latin", "m"): "n", ("latin", "f"): "a", ("greek", "m"): "ος", ("greek", "f"): "α",
           ("cyrillic", "m"): "н", ("cyrillic", "f"): "а"}


def luhn(digits: str) -> int:
    """The check digit that follows ``digits``."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (2 if i % 2 == 0 else 1)
        total += n - 9 if n > 9 else n
    return -total % 10


def script_of(word: str) -> str:
    c = word[0]
    return "greek" if "Ͱ" <= c <= "Ͽ" else "cyrillic" if "Ѐ" <= c <= "ӿ" else "latin"


class Mention:
    """A found entity: code point range, kind, canonical form, gender, surface form."""

    __slots__ = ("start", "end", "kind", "canon", "gender", "surface")

    def __init__(self, start: int, end: int, kind: str, canon: str, gender: str, surface: str):
        self.start, self.end, self.kind, self.canon, self.gender, self.surface = start, end, kind, canon, gender, surface


def mentions(text: str) -> list[Mention]:
    """All entities of a text, in order, without overlaps (earlier kinds win)."""
    taken = bytearray()  # one flag per character, once there is a mention
    out: list[Mention] = []
    surnames: set[str] = set()

    def free(a: int, b: int) -> bool:
        return not taken or 1 not in taken[a:b]

    def take(a: int, b: int) -> None:
        if not taken:
            taken.extend(bytes(len(text)))
        taken[a:b] = b"\x01" * (b - a)

    for kind, pattern in PATTERNS:
        if (kind in ("email",) and "@" not in text):
            continue
        for m in pattern.finditer(text):
            if not free(*m.span()):
                continue
            raw = m.group()
            if kind == "card":
                digits = re.sub(r"\D", "", raw)
                if not 13 <= len(digits) <= 19 or luhn(digits[:-1]) != int(digits[-1]):
                    continue
                out.append(Mention(*m.span(), kind, digits, "", raw))
            elif kind == "email":
                out.append(Mention(*m.span(1), "local", m[1].lower(), "", m[1]))
                out.append(Mention(*m.span(2), "domain", m[2].lower(), "", m[2]))
            elif kind == "phone":
                out.append(Mention(*m.span(), kind, re.sub(r"[^\d+]", "", raw), "", raw))
            elif kind == "person":
                gender = TITLES[m[1].lower()]
                if m[3]:
                    given = m[2].lower()
                    gender = gender or next((g for g, names in GIVEN.items() if given in names), "")
                    out.append(Mention(*m.span(2), "given", given, gender, m[2]))
                last = 3 if m[3] else 2
                out.append(Mention(*m.span(last), "surname", m[last].lower(), "", m[last]))
                surnames.add(m[last])
            else:
                out.append(Mention(*m.span(), kind, raw, "", raw))
            take(*m.span())
    if surnames:  # coreference: the surname alone, later or earlier
        for m in _ALONE.finditer(text):
            if m.group() in surnames and free(*m.span()):
                out.append(Mention(*m.span(), "surname", m.group().lower(), "", m.group()))
                take(*m.span())
    out.sort(key=lambda x: x.start)
    return out


def _stream(key: bytes, *parts: str) -> Iterator[int]:
    n = 0
    while True:
        yield from hashlib.blake2b("\x1f".join([*parts, str(n)]).encode(), key=key, digest_size=64).digest()
        n += 1


def surrogate(key: bytes, kind: str, canon: str, gender: str, attempt: int) -> str:
    """Replacement of an entity in canonical form."""
    rnd = _stream(key, kind, canon, str(attempt))

    def pick(chars: str) -> str:
        return chars[(next(rnd) << 8 | next(rnd)) % len(chars)]

    if kind in ("given", "surname"):
        script = script_of(canon)
        vowels, consonants = _VOWELS[script], _CONSONANTS[script]
        size = max(5, min(12, len(canon))) + attempt // 8
        name = "".join(pick(consonants if i % 2 == 0 else vowels) for i in range(size))
        end = _ENDING.get((script, gender), "") if kind == "given" else ""
        if not end:
            return name
        # a consonant goes before an ending that starts with a vowel, and a vowel before another
        odd = len(name) % 2 == 1
        return (name if odd == (end[0] in "".join(_VOWELS.values())) else name[:-1]) + end
    if kind == "card":
        digits = canon[0] + "".join(pick("0123456789") for _ in canon[1:-1])
        return digits + str(luhn(digits))
    if kind == "ip":
        return ".".join(str(1 + (next(rnd) << 8 | next(rnd)) % 254) for _ in range(4))
    if kind == "phone":
        head = re.match(r"\+\d{1,3}(?=\d{10})|\+\d|", canon).group()
        return head + "".join(pick("23456789" if i in (0, 3) else "0123456789") for i in range(len(canon) - len(head)))
    # short ones may all be real: later tries grow
    more = "x" * (attempt // 4)
    if kind == "domain":
        body, _, tld = canon.rpartition(".")
        return _like(body + more, pick) + "." + tld
    return _like(canon + more, pick)


def _like(text: str, pick) -> str:
    return "".join(pick("abcdefghijklmnopqrstuvwxyz") if c.isalpha() else pick("0123456789") if c.isdigit() else c for c in text)


def fitted(m: Mention, replacement: str) -> str:
    """The canonical replacement in the mention's own format and letter case."""
    if m.kind in ("card", "phone"):
        digits = iter(replacement.lstrip("+"))
        return "".join(next(digits) if c.isdigit() else c for c in m.surface)
    if m.kind in ("given", "surname"):
        return replacement.upper() if m.surface.isupper() else replacement.capitalize()
    if m.surface != m.surface.lower():
        return "".join(r.upper() if s.isupper() else r for s, r in zip_longest(m.surface, replacement, fillvalue=""))
    return replacement


def rewrite(text: str, key: bytes, tries: dict[tuple[str, str, str], int]) -> tuple[str, list[str]]:
    out, kinds, at = [], [], 0
    for m in mentions(text):
        out.append(text[at:m.start])
        out.append(fitted(m, surrogate(key, m.kind, m.canon, m.gender, tries.get((m.kind, m.canon, m.gender), 0))))
        kinds.append(m.kind)
        at = m.end
    return "".join([*out, text[at:]]), kinds


ENTITY = ["kind", "canon", "gender"]


def entities(docs: DataFrame) -> DataFrame:
    """Distinct entities of all texts."""
    arrow_batches(docs.sparkSession)

    def run(batches):
        for b in batches:
            found = sorted({(m.kind, m.canon, m.gender) for t in b.column(0).to_pylist() if t for m in mentions(t)})
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in (zip(*found) if found else ([], [], []))], ENTITY)

    return docs.select("text").mapInArrow(run, "kind string, canon string, gender string").distinct()


def candidates(rows: DataFrame, key: bytes, attempt: int) -> DataFrame:
    def run(batches):
        for b in batches:
            cols = [b.column(c).to_pylist() for c in ENTITY]
            yield b.append_column("surrogate", pa.array([surrogate(key, *x, attempt) for x in zip(*cols)], pa.string()))

    return rows.select(*ENTITY).mapInArrow(run, "kind string, canon string, gender string, surrogate string")


def later_tries(found: DataFrame, key: bytes) -> DataFrame:
    """Entities whose surrogate is not that of try 0: kind, canon, gender, attempt.

    Each round checks the round's surrogates against all real entities, against the
    surrogates given before, and against each other."""
    real = found.select("kind", F.col("canon").alias("surrogate")).distinct()
    given = candidates(found, key, 0)
    later = None
    open_ = None
    for attempt in range(TRIES):
        mine = given if attempt == 0 else candidates(open_, key, attempt)
        mine = table(mine, f"surrogates-{attempt}")
        first = mine.groupBy("kind", "surrogate").agg(F.min(F.struct("canon", "gender")).alias("first"), F.count(F.lit(1)).alias("n"))
        clash = first.filter("n > 1").select("kind", "surrogate", "first")
        bad = mine.join(real, ["kind", "surrogate"], "left_semi").select(*ENTITY)
        lost = mine.join(clash, ["kind", "surrogate"]).filter(F.struct("canon", "gender") != F.col("first")).select(*ENTITY)
        bad = bad.unionByName(lost)
        if attempt:
            bad = bad.unionByName(mine.join(settled, ["kind", "surrogate"], "left_semi").select(*ENTITY))  # noqa: F821
        bad = table(bad.distinct(), f"clashes-{attempt}")
        good = mine.join(bad, ENTITY, "left_anti")
        if attempt:
            part = good.select(*ENTITY, F.lit(attempt).alias("attempt"))
            later = part if later is None else later.unionByName(part)
        settled = good.select("kind", "surrogate") if attempt == 0 else settled.unionByName(good.select("kind", "surrogate"))
        if bad.isEmpty():
            break
        open_ = bad
    else:
        raise RuntimeError(f"no distinct surrogates within {TRIES} tries")
    return later if later is not None else found.limit(0).withColumn("attempt", F.lit(0))


RESULT = "doc_id long, text string, n_entities long, kinds string"


def replace_pii(docs: DataFrame, key: bytes, local: int = LOCAL) -> DataFrame:
    """doc_id, rewritten text, number and kinds of the replaced entities."""
    arrow_batches(docs.sparkSession)
    found = table(entities(docs), "entities")
    later = later_tries(found, key)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    few = later.limit(local + 1).toArrow()
    if few.num_rows > local:
        return _joined(rows, key, later)
    tries = share(docs, {(r["kind"], r["canon"], r["gender"]): r["attempt"] for r in few.to_pylist()})

    def run(batches):
        for b in batches:
            yield _result(b.column(0), [None if t is None else rewrite(t, key, tries.value) for t in b.column(1).to_pylist()])

    return rows.mapInArrow(run, RESULT)


def _result(ids, got) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [ids, pa.array([g and g[0] for g in got], pa.string()), pa.array([len(g[1]) if g else 0 for g in got], pa.int64()),
         pa.array([",".join(g[1]) if g else "" for g in got], pa.string())], ["doc_id", "text", "n_entities", "kinds"])


def _joined(rows: DataFrame, key: bytes, later: DataFrame) -> DataFrame:
    """The same where the later tries are too many to broadcast: each text is joined with
    those of its own entities."""

    def run(batches):
        for b in batches:
            out = []
            for t in b.column(0).to_pylist():
                out += [(t, *e) for e in sorted({(m.kind, m.canon, m.gender) for m in mentions(t)})] if t else []
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in (zip(*out) if out else [[]] * 4)], ["text", *ENTITY])

    own = (rows.select("text").mapInArrow(run, "text string, kind string, canon string, gender string")
           .select(F.sha2("text", 256).alias("sha"), *ENTITY).distinct().join(later, ENTITY)
           .groupBy("sha").agg(F.collect_list(F.struct(*ENTITY, "attempt")).alias("tries")))

    def finish(batches):
        for b in batches:
            got = []
            for t, tries in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                got.append(None if t is None else rewrite(
                    t, key, {(r["kind"], r["canon"], r["gender"]): r["attempt"] for r in tries or ()}))
            yield _result(b.column(0), got)

    return (rows.withColumn("sha", F.sha2(F.coalesce("text", F.lit("")), 256)).join(own, "sha", "left")
            .select("doc_id", "text", "tries").mapInArrow(finish, RESULT))
