"""Secret scans by assignment-aware lexing.

Three fixed patterns give the base spans. Beyond them, the text is lexed around its
separators into pairs of a name and a literal, as source code and configuration files
write them (``db_pass = "..."``, ``"clientSecret": "..."``, ``export KEY=...``). A bare
value that names an earlier pair stands for that pair's literal, so constants carry
through. A literal is reported if the names it is assigned to are sensitive and it
looks random enough for them.
"""

from __future__ import annotations

import math
import re
import string
from array import array
from collections import Counter
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# The base patterns and their least lengths.
ASSIGN = re.compile(
    r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]"
    r"|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ASSIGN_LENGTH = 12
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
#: Kinds in the order in which spans of equal starts are listed.
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "named")

#: Parts of names and how sensitive they make what is assigned to them.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "pass": 0.8, "secret": 1.0,
    "token": 0.9, "apikey": 1.0, "credential": 0.9, "credentials": 0.9, "cred": 0.8,
    "bearer": 0.8, "auth": 0.7, "private": 0.6, "access": 0.4, "key": 0.5, "api": 0.4,
    "client": 0.2, "signing": 0.5, "encryption": 0.5,
}
REPORTED = 0.55
LEAST_LITERAL = 8

SEPARATOR = re.compile(r"=>|:=|[:=]")
NAME_CHARACTERS = string.ascii_letters + string.digits + "_$.-"
#: A type between a name's colon and "=". Possessive, so that long texts stay linear.
TYPE = re.compile(
    r"[ \t]*+(?:[&*]|'\w++[ \t]++|mut[ \t]++)*+[A-Za-z_]\w*+(?:(?:\.|::)\w++)*+"
    r"(?:\[[^\n=;\"]*\]|<[^\n=;\"]*>)?+[?!]?+(?:[ \t]*+\|[ \t]*+[A-Za-z_][\w.]*+(?:\[[^\n=;\"\]]*+\])?+)*+[ \t]*+",
    re.ASCII,
)
#: Types that follow a name without a colon, and words after which any type may.
PLAIN_TYPES = {"string", "str", "String"}
DECLARING = {"var", "const", "let", "val"}
LITERAL = re.compile(
    r"[ \t]*(?:\"((?:[^\"\\\n]|\\.)*)\"|'((?:[^'\\\n]|\\.)*)'|`([^`\n]*)`|([^\s\"'`,;(){}\[\]<>]+))"
)
IDENTIFIER = re.compile(r"[$]?[A-Za-z_][\w.]*", re.ASCII)
NAME_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")
PLACEHOLDER = re.compile(r"(?i)(?:x+|\*+|changeme|example|placeholder|none|null|true|false|todo|\$\{?\w+\}?)")
#: What a placeholder may begin with, whatever follows.
YOURS = re.compile("(?i)your")
DIGIT = re.compile(r"\d")
#: Literals up to this length are counted one by one; longer ones share the counts of all
#: that end where they do.
COUNTED = 256


@lru_cache(maxsize=1 << 14)
def _sensitivity(name: str) -> float:
    """0 to 1: how likely the name is to hold a secret."""
    parts = [p.lower() for p in NAME_PARTS.findall(name)]
    return min(1.0, sum(SENSITIVE.get(p, 0.0) for p in set(parts)))


def sensitivity(name: str) -> float:
    return _sensitivity(name) if len(name) <= COUNTED else _sensitivity.__wrapped__(name)


class Randomness:
    """0 to 1 for the literals of a text: bits of entropy a character, as a share of 3.5.

    Literals may end at the same place and begin at many, so the entropies of all that
    end there are found in one walk back to the first of them.
    """

    def __init__(self, text: str):
        self._text = text
        self._known: dict[tuple[int, int], float] = {}
        self._bits: dict[int, tuple[int, array]] = {}  # by end: the first start, bits from the end back

    def __call__(self, start: int, end: int) -> float:
        if (found := self._known.get((start, end))) is None:
            found = self._known[start, end] = self._of(start, end)
        return found

    def _of(self, start: int, end: int) -> float:
        text, n = self._text, end - start
        if n < LEAST_LITERAL or YOURS.match(text, start, end) or PLACEHOLDER.fullmatch(text, start, end):
            return 0.0
        if n <= COUNTED:
            bits = -sum(k / n * math.log2(k / n) for k in Counter(text[start:end]).values())
        else:
            if end not in self._bits or start < self._bits[end][0]:
                self._bits[end] = start, self._backwards(start, end)
            bits = self._bits[end][1][n - 1]
        return min(1.0, bits / 3.5)

    def _backwards(self, start: int, end: int) -> array:
        counts: Counter = Counter()
        total, bits = 0.0, array("d")
        for n, letter in enumerate(reversed(self._text[start:end]), 1):
            k = counts[letter]
            counts[letter] = k + 1
            total += (k + 1) * math.log2(k + 1) - (k * math.log2(k) if k else 0.0)
            bits.append(math.log2(n) - total / n)
        return bits


def _last_name(text: str) -> tuple[str, str]:
    """The name at the end of a text, or "", and what stands before it."""
    text = text.removesuffix("\n").rstrip(" \t").removesuffix("]")
    if text.endswith(("\"", "'", "`")):
        text = text[:-1]
    before = text.rstrip(NAME_CHARACTERS)
    name = text[len(before) :].lstrip(string.digits + ".-")
    return name, text[: len(text) - len(name)]


def _declared(name: str, before: str) -> str:
    """The name that ``name`` is the type of, as in ``var token string``, or ""."""
    if before == (rest := before.rstrip(" \t*&")):
        return ""
    owner = rest[len(rest.rstrip(NAME_CHARACTERS)) :]
    if not IDENTIFIER.fullmatch(owner) or owner in DECLARING:
        return ""
    ahead = rest[: len(rest) - len(owner)].rstrip(" \t")
    word = ahead[len(ahead.rstrip(NAME_CHARACTERS)) :]
    return owner if name in PLAIN_TYPES or word in DECLARING else ""


def pairs(text: str):
    """(names, start, end, bare) of every assignment, in order.

    The first name is the target. A second one is its type, which may be a name, too. The
    text between two separators is looked at once, however long names and padding are, and so
    is a run of characters that several bare literals end with.
    """
    done = 0
    run, digit = 0, (-1, -1)  # the end of the last bare literal; its last digit, by its end
    colon = None  # the name of the last colon and where it ends
    held = None  # its pair, until it is known whether its value is a type
    for sep in SEPARATOR.finditer(text):
        between, done = text[done : sep.start()], sep.end()
        name, before = _last_name(between)
        typed = sep[0] == "=" and colon and TYPE.fullmatch(text, colon[1], sep.start())
        owner = colon[0] if typed else _declared(name, before) if sep[0] == "=" and name else ""
        names = tuple(n for n in (owner, name) if n)
        if not names:
            pair = None
        elif done < run:  # the rest of a bare literal is one, too
            pair = (names, done, run, True)
        else:
            value = LITERAL.match(text, done)
            group = value.lastindex if value else None
            pair = (names, value.start(group), value.end(group), group == 4) if value else None
            run = value.end() if group == 4 else run
        if colon and sep[0] == ":" and (text.startswith(":", done) or text.endswith(":", 0, sep.start())):
            if pair:  # of a "::", maybe within a type
                yield pair
            continue
        if held and typed:  # a type is no constant, and no literal before a quoted one
            if digit[0] != held[2]:
                digit = held[2], max((m.start() for m in DIGIT.finditer(text, held[1], held[2])), default=-1)
            if not (pair and not pair[3]) or digit[1] >= held[1]:
                yield (*held[:3], False)
        elif held:
            yield held
        colon = held = None
        if sep[0] == ":" and name:
            colon, held = (name, done), pair
        elif pair:
            yield pair
    if held:
        yield held


def named_spans(text: str) -> list[tuple[str, int, int, float]]:
    """(name, start, end, score) of literals whose targets are sensitive."""
    constants: dict[str, tuple[int, int]] = {}
    best: dict[tuple[int, int], tuple[float, str]] = {}
    randomness = Randomness(text)
    for names, start, end, bare in pairs(text):
        at = (start, end)
        if bare and (named := IDENTIFIER.fullmatch(text, start, end)):
            at = constants.get(named[0].lstrip("$"), at)
        constants[names[0].lstrip("$")] = at
        for name in names:
            if sensitive := sensitivity(name):
                score = sensitive * randomness(*at)
                if score >= REPORTED:
                    best[at] = max(best.get(at, (0.0, "")), (score, name))
    return [(name, a, b, score) for (a, b), (score, name) in best.items()]


def spans(text: str) -> list[tuple[str, int, int, str | None, float]]:
    """(kind, start, end, name, score) of all spans, by start, then kind."""
    assigns = "=" in text or ":" in text
    found = [
        ("assign", m.start(), m.end(), m[1], 1.0)
        for m in (ASSIGN.finditer(text) if assigns else ())
        if m.end(2) - m.start(2) >= ASSIGN_LENGTH
    ]
    for kind, pattern in (("access", ACCESS), ("hex", HEX)):
        found += [(kind, m.start(), m.end(), None, 1.0) for m in pattern.finditer(text)]
    if assigns:
        found += [("named", a, b, name, score) for name, a, b, score in named_spans(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


SPAN = pa.struct(
    [("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("name", pa.string()), ("score", pa.float64())]
)


def _scan(batches):
    for batch in batches:
        found = [
            [dict(zip(("kind", "start", "end", "name", "score"), s, strict=True)) for s in spans(t.as_py() or "")]
            for t in batch.column("text")
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(found, pa.list_(SPAN))], names=["doc_id", "spans"]
        )


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, spans): an array of (kind, start, end, name, score) per document.

    Offsets count code points, the end is exclusive. Whole texts are lexed; null texts
    are empty and have no spans. Rows are independent: repeated rows give repeated
    results, null ids stay null, extra columns are ignored, an empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(
        _scan,
        "doc_id long, spans array<struct<kind string, start int, end int, name string, score double>>",
    )


def digests(scanned: DataFrame) -> DataFrame:
    """Counts by base kind, a digest of the base spans, and all spans as text."""
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    written = lambda found: F.array_join(
        F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    return scanned.select(
        "doc_id",
        *[of(kind).alias(f"n_{kind}") for kind in BASE_KINDS],
        F.sha2(written(base), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )
