"""Personal data by anchor expansion.

One Aho-Corasick automaton finds the anchors of all kinds in one pass: at-signs, schemes, digits
beside digits, dots or plus signs, and cues of identifiers and secrets. A small parser per kind expands an anchor
to both sides, up to the end of the match before, and validates what it found.
"""

from __future__ import annotations

import hashlib
import re
from functools import cache
from itertools import product

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelmetrics.llm.common import ship_package, whole_text

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "url", "account", "key", "secret")

# The characters and shapes of the kinds.
LOCAL_PART = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
SCHEME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")
DIGITS = frozenset("0123456789")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
AUTHORITY = re.compile(r"[^\s<>\"'`{}|\\^]+")
IBAN = re.compile(r"[\x20:#=]{0,3}([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){10,30})(?![A-Za-z0-9])")
ACCOUNT = re.compile(r"(?:\x20(?:no\.?|number|nr\.?))?[\x20:#=]{1,3}([0-9](?:[\x20-]?[0-9]){5,16})(?![A-Za-z0-9])")
ACCESS_KEY = re.compile(r"[A-Z0-9]{16}(?![A-Za-z0-9])")
# The name of a secret up to its value, the shapes of values, and how tokens of known issuers begin.
ASSIGNED = re.compile(
    r"(?:(?:[Aa][Pp][Ii]|[Aa][Cc][Cc][Ee][Ss][Ss])\x20)?[A-Za-z0-9_-]{1,40}[\"'\])]{0,2}[\x20\t]{0,3}(?::=|=>|[:=])[\x20\t]{0,3}[\"'`]?"
)
CARRIED = re.compile(r"[A-Za-z]{6}[\x20\t]{1,3}")
SECRET = re.compile(r"[A-Za-z0-9_+/.~-]{12,}={0,2}")
PASSWORD = re.compile(r"[^\s\"'`,;<>]{6,}")
ISSUED = re.compile(r"[A-Za-z]{2,6}[_-]?[A-Za-z0-9_.-]{16,}")
PRIVATE_KEY = re.compile(r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----[A-Za-z0-9+/=\s]*(?:-----END (?:[A-Z]+ )?PRIVATE KEY-----)?")
SECRET_CUES = ("token", "secret", "api_key", "api-key", "api key", "apikey", "access_key", "access key", "credential", "private_key")
PASSWORD_CUES = ("password", "passwd", "passphrase")
ISSUERS = ("ghp_", "gho_", "ghs_", "ghu_", "github_pat_", "glpat-", "xoxa-", "xoxb-", "xoxp-", "sk_live_", "sk-", "AIza", "eyJ")
CUES = {"iban": ("iban", "IBAN", "Iban"), "account": ("account", "Account", "ACCOUNT", "acct", "Acct", "ssn", "SSN")}

Span = tuple[int, int]


@cache
def _automaton() -> ahocorasick.Automaton:
    """Anchors with their kind and the offset from the end of the anchor to its first character."""
    digits = sorted(DIGITS)
    anchors = {"@": "email", "://": "url", "AKIA": "key"}
    anchors |= {f"{a}.{b}": "ip" for a, b in product(digits, digits)}
    anchors |= {f"{a}{sep}{b}": "card" for a, sep, b in product(digits, ("", " ", "-"), digits)}
    anchors |= {f"+{a}": "phone" for a in digits}
    anchors |= {cue: kind for kind, cues in CUES.items() for cue in cues}
    for kind, cues in (("secret", SECRET_CUES), ("password", PASSWORD_CUES), ("bearer", ("bearer",))):
        anchors |= {spelled: kind for cue in cues for spelled in (cue, cue.upper(), cue.capitalize(), cue.title())}
    anchors |= dict.fromkeys(ISSUERS, "issued") | {"-----BEGIN ": "private"}
    automaton = ahocorasick.Automaton()
    for anchor, kind in anchors.items():
        automaton.add_word(anchor, (kind, len(anchor) - 1))
    automaton.make_automaton()
    return automaton


def _back(text: str, at: int, floor: int, allowed: frozenset[str]) -> int:
    """The start of the run of allowed characters that ends before ``at``."""
    while at > floor and text[at - 1] in allowed:
        at -= 1
    return at


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _email(text: str, at: int, floor: int) -> tuple[Span, bool] | None:
    start = _back(text, at, floor, LOCAL_PART)
    domain = DOMAIN.match(text, at + 1) if start < at else None
    return ((start, domain.end()), True) if domain else None


def _ip(text: str, at: int, floor: int) -> tuple[Span, bool] | None:
    found = DOTTED.match(text, _back(text, at, floor, DIGITS))
    if not found:
        return None
    parts = [p.lstrip("0") for p in found[0].split(".")]
    return found.span(), all(len(p) < 3 or len(p) == 3 and p <= "255" for p in parts)


def _card(text: str, at: int, floor: int) -> tuple[Span, bool] | None:
    found = CARD.match(text, at)
    digits = found[0].replace(" ", "").replace("-", "")
    return found.span(), 14 <= len(digits) <= 19 and _luhn(digits)


def _phone(text: str, at: int, floor: int) -> tuple[Span, bool] | None:
    found = PHONE.match(text, at)
    return (found.span(), 10 <= sum(c in DIGITS for c in found[0]) <= 15) if found else None


def _url(text: str, at: int, floor: int) -> tuple[Span, bool] | None:
    """An address with a scheme of letters first; stops of a sentence at its end are no part of it."""
    start = _back(text, at, floor, SCHEME)
    while start < at and not text[start].isalpha():
        start += 1
    found = AUTHORITY.match(text, at + 3) if start < at else None
    rest = found[0].rstrip(".,;:!?)]") if found else ""
    return ((start, at + 3 + len(rest)), True) if rest and rest[0].isalnum() else None


def _iban(text: str, at: int, floor: int) -> tuple[Span, bool] | None:
    found = IBAN.match(text, at + 4)
    if not found:
        return None
    number = found[1].replace(" ", "")
    moved = "".join(str(int(c, 36)) for c in number[4:] + number[:4])
    return found.span(1), 15 <= len(number) <= 34 and int(moved) % 97 == 1


def _account(text: str, at: int, floor: int) -> tuple[Span, bool] | None:
    end = at
    while end < len(text) and text[end].isalpha():
        end += 1
    found = ACCOUNT.match(text, end)
    return (found.span(1), True) if found else None


def _key(text: str, at: int, floor: int) -> tuple[Span, bool] | None:
    found = ACCESS_KEY.match(text, at + 4)
    return ((at, found.end()), not (at and text[at - 1].isalnum())) if found else None


def _random_looking(body: str) -> bool:
    """Whether a value can be a secret: many different characters, digits among letters or both cases mixed."""
    digits, letters = any(c in DIGITS for c in body), any(c.isalpha() for c in body)
    mixed = body.lower() != body != body.upper()
    return len(set(body)) >= 6 and (digits and (letters or len(body) >= 20) or mixed and len(body) >= 20)


def _behind(cue: re.Pattern, shape: re.Pattern):
    """A parser of the value that follows the name of a secret."""

    def parse(text: str, at: int, floor: int) -> tuple[Span, bool] | None:
        name = cue.match(text, at)
        found = shape.match(text, name.end()) if name else None
        if not found:
            return None
        body = found[0].rstrip(".")
        valid = _random_looking(body) if shape is SECRET else len(set(body)) >= 4 and not body.isalpha()
        return (found.start(), found.start() + len(body)), valid

    return parse


def _issued(text: str, at: int, floor: int) -> tuple[Span, bool] | None:
    """A token whose beginning tells who issued it."""
    found = ISSUED.match(text, at)
    if not found or at and (text[at - 1].isalnum() or text[at - 1] == "_"):
        return None
    body = found[0].rstrip(".-")
    return (at, at + len(body)), _random_looking(body)


def _private(text: str, at: int, floor: int) -> tuple[Span, bool] | None:
    found = PRIVATE_KEY.match(text, at)
    return (found.span(), True) if found else None


# The parser of an anchor, and the kind under which its spans are listed.
PARSERS = {
    "email": (_email, "email"),
    "ip": (_ip, "ip"),
    "card": (_card, "card"),
    "phone": (_phone, "phone"),
    "url": (_url, "url"),
    "iban": (_iban, "account"),
    "account": (_account, "account"),
    "key": (_key, "key"),
    "secret": (_behind(ASSIGNED, SECRET), "secret"),
    "password": (_behind(ASSIGNED, PASSWORD), "secret"),
    "bearer": (_behind(CARRIED, SECRET), "secret"),
    "issued": (_issued, "secret"),
    "private": (_private, "secret"),
}


def personal_spans(text: str) -> list[tuple[int, int, str]]:
    """All spans of a text as (start, end, kind) by start, then kind; code points, end exclusive.

    Within a kind spans don't overlap. A match that fails its validation is dropped, and the
    search goes on behind it.
    """
    ends = dict.fromkeys(KINDS, 0)
    found = []
    ip_at = 1  # the anchor of an address begins with the digit before its dot
    for end, (anchor, before) in _automaton().iter(text):
        parse, kind = PARSERS[anchor]
        at = end - before + (ip_at if anchor == "ip" else 0)
        if at < ends[kind]:
            continue
        parsed = parse(text, at, ends[kind])
        if parsed:
            (start, stop), valid = parsed
            ends[kind] = stop
            if valid:
                found.append((start, KINDS.index(kind), stop))
    return [(start, stop, KINDS[k]) for start, k, stop in sorted(found)]


def _listed(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{stop}" for start, stop, kind in spans)


RESULT = "struct<spans: string, n_spans: bigint, base: string, n_email: bigint, n_ip: bigint, n_card: bigint, n_phone: bigint>"


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_spans``.

    ``spans`` lists the ``n_spans`` places ``kind:start:end`` of all kinds, ``base_sha256`` is the digest of such a list
    of the four base kinds, which are counted. Null text counts as empty; a text without spans
    gives an empty list. Rows that repeat an id give a row each; a null id stays null; an empty
    table gives an empty result. Other columns are not read.
    """
    ship_package(docs.sparkSession)

    @F.arrow_udf(RESULT)
    def scan(texts: pa.Array) -> pa.Array:
        found: list[list] = [[] for _ in range(3 + len(BASE_KINDS))]
        for text in texts:
            spans = personal_spans(text.as_py())
            base = [s for s in spans if s[2] in BASE_KINDS]
            found[0].append(_listed(spans))
            found[1].append(len(spans))
            found[2].append(hashlib.sha256(_listed(base).encode()).hexdigest())
            for column, kind in zip(found[3:], BASE_KINDS):
                column.append(sum(s[2] == kind for s in base))
        types = [pa.string(), pa.int64(), pa.string()] + [pa.int64()] * len(BASE_KINDS)
        names = ["spans", "n_spans", "base", *(f"n_{k}" for k in BASE_KINDS)]
        return pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(found, types)], names)

    counts = [F.col(f"found.n_{k}").alias(f"n_{k}") for k in BASE_KINDS]
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), scan(whole_text(text_col)).alias("found")).select(
        "doc_id", *counts, F.col("found.base").alias("base_sha256"), F.col("found.spans").alias("spans"), "found.n_spans"
    )
