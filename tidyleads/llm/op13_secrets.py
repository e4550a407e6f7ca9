"""Secret scan by assignment-aware lexing.

Plain patterns (the base) find what looks like a secret wherever it stands.  Beside them, the
text is read as source or configuration: around every ``=``, ``:`` and XML tag the lexer reads
a target name and a value, made of string literals, bare words and names, joined by ``+``, ``.``
or mere adjacency.  Values go into an environment, so a literal reaches the names that are
assigned from it later, over any number of steps (``a = "..."``, ``b = a``, ``password = b``), also as
``$a`` and ``${a}``.  Each literal is then scored: how sensitive the name is that it arrives at
(parts of the name, snake, kebab or camel case) times how much it looks like a secret (Shannon
bits, mixed classes; placeholders and references score 0).  Literals that reach ``threshold``
and overlap no base span become spans of kind ``literal``.

A document's lexing is linear in its text: the environment keeps links to earlier values, never
copies, and a value is walked once per level of sensitivity.  Nothing is shuffled; memory is
one Arrow batch.  Positions are code points, ends exclusive.  Null and empty texts have no
span; repeated rows and null ids each give their own row; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import split

#: Kinds in the order of the report; the first three are the base.
KINDS = ("assign", "access", "hex", "literal")
THRESHOLD = 0.5

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_NEEDED = ("passw", "secret", "token", "api")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the plain patterns' matches."""
    # most texts hold none of the words: a plain search is faster than the pattern
    low = text.lower()
    out = []
    if any(w in low for w in _NEEDED):
        out = [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    out += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text)] if "AKIA" in text else []
    out += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return out


# ---------------------------------------------------------------------------
# Names and literals
# ---------------------------------------------------------------------------
_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
#: Name parts that make a target sensitive; pairs are joined parts.
STRONG = {"password", "passwd", "pwd", "pass", "passphrase", "passcode", "secret", "secrets", "token", "apikey", "credential",
          "credentials", "privatekey", "secretkey", "accesskey", "authkey", "signingkey", "encryptionkey", "clientkey", "masterkey"}
WEAK = {"auth", "authorization", "bearer", "key", "cert", "signature", "session", "cookie", "salt", "pin", "dsn", "webhook"}
#: Parts that, at the end of a name, say that the value describes a secret but is none.
ABOUT = {"count", "length", "len", "size", "type", "name", "id", "url", "uri", "path", "file", "hint", "policy", "expiry", "expires",
         "ttl", "limit", "label", "field", "column", "format", "version", "public", "enabled", "required", "min", "max", "prompt",
         "reset", "status", "index", "algorithm", "alg"}
_PLACEHOLDER = re.compile(r"(?i)^(x+|\*+|\.+|-+|_+|null|none|true|false|changeme|example|placeholder|todo|redacted|your[_ -].*|my[_ -].*|<.*>|\{\{.*\}\}|%\(?\w+\)?s?|\$\{?\w+\}?)$")


def name_weight(name: str) -> float:
    """1 for names of secrets, 0.5 for names near them, else 0."""
    parts = [p.lower() for p in _PART.findall(name)]
    if not parts or parts[-1] in ABOUT or "public" in parts:
        return 0.0
    whole = set(parts) | {a + b for a, b in zip(parts, parts[1:])}
    if whole & STRONG:
        return 1.0
    return 0.5 if whole & WEAK else 0.0


def literal_score(value: str, quoted: bool) -> float:
    """0 to 1: Shannon bits of all that was joined, over 38; bare or spaced words of one class count 0.4 of that."""
    value = _SHELL.sub("", value)
    if len(value) < 6 or _PLACEHOLDER.match(value):
        return 0.0
    n = len(value)
    bits = -sum(c * math.log2(c / n) for c in Counter(value).values())
    classes = any(c.isdigit() for c in value) + any(c.isalpha() for c in value) + any(not c.isalnum() and c not in " \t.,'-" for c in value)
    plain = classes < 2 and (not quoted or " " in value)
    return min(1.0, bits / 38) * (0.4 if plain else 1.0)


# ---------------------------------------------------------------------------
# The lexer
# ---------------------------------------------------------------------------
_OPERATOR = re.compile(r"[:=]|<(?=[A-Za-z_])")
_BLANK = " \t"
_NAME_CHAR = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_-.$")
_TAG = re.compile(r"<([A-Za-z_][\w.-]*)>([^<>\n]+)</\1>")
_STRING = re.compile(r'''[A-Za-z]{0,2}(?:"((?:[^"\\\n]|\\.)*)"|'((?:[^'\\\n]|\\.)*)'|`([^`\n]*)`)''')
_SHELL = re.compile(r"\$\{(\w+)\}|\$(\w+)")
#: A bare value ends before the next operator, but keeps base64's padding.
_BARE = re.compile(r"""[^\s,;"'`()\[\]{}<>=:]+(?:={1,2}(?=[\s,;]|$))?""")
_TYPE = re.compile(r"[ \t]*[A-Za-z_][\w.\[\], |]*")
_IDENT = re.compile(r"^[A-Za-z_][\w.]*$")
_JOIN = re.compile(r"[ \t]*(?:\+|\.\.?(?=[ \t]*[\"'])|\\\n)?[ \t]*")


class _Value:
    """What a name was assigned: literals (start, end, text, quoted) and links to earlier values."""
    __slots__ = ("literals", "links", "walked")

    def __init__(self, literals, links):
        self.literals, self.links, self.walked = literals, links, 0.0


def _target(text: str, at: int, floor: int) -> str:
    """The name that ends before position ``at``; the search ends at ``floor``."""
    i = at
    while i > floor and text[i - 1] in _BLANK:
        i -= 1
    if i > floor and text[i - 1] in ":+?|&!<>=":  # :=, +=, ?=, ||=
        i -= 1
        while i > floor and text[i - 1] in _BLANK:
            i -= 1
    while i > floor and text[i - 1] in "\"']":
        i -= 1
    end = i
    while i > floor and text[i - 1] in _NAME_CHAR:
        i -= 1
    return text[i:end]


def _operand(text: str, at: int):
    """(literal or None, name or None, end) of the operand at a position; None where there is none."""
    if m := _STRING.match(text, at):
        g = m.lastindex
        return (m.start(g), m.end(g), m.group(g), True), None, m.end()
    if m := _SHELL.match(text, at):
        return None, m.group(1) or m.group(2), m.end()
    if m := _BARE.match(text, at):
        word = m.group().rstrip(".:+") if len(m.group()) > 1 else m.group()
        if word:
            name = word if _IDENT.match(word) else None
            return (m.start(), m.start() + len(word), word, False), name, m.start() + len(word)
    return None


def assignments(text: str):
    """(target name, literals, referred names) of each assignment, in order."""
    floor, typed = 0, None
    for m in _OPERATOR.finditer(text):
        if m.start() < floor:
            continue
        if m.group() == "<":
            if t := _TAG.match(text, m.start()):
                yield t.group(1), [(t.start(2), t.end(2), t.group(2), True)], []
                floor = t.end()
            continue
        name = _target(text, m.start(), floor)
        if m.group() == "=" and typed and _TYPE.fullmatch(text, floor, m.start()):
            name = typed  # "name: type = value"
        typed = name if m.group() == ":" else None
        at = m.end()
        while at < len(text) and (text[at] in "=>" or text[at] in _BLANK):
            at += 1
        literals, names = [], []
        while (found := _operand(text, at)) is not None:
            literal, ref, at = found
            if ref:
                names.append((ref, literal))
            else:
                literals.append(literal)
            nxt = _JOIN.match(text, at).end()
            # more of the value follows a joining sign, or is a string beside a string
            if nxt == at or not (text[at:nxt].strip(_BLANK) or (literal and literal[3] and text[nxt:nxt + 1] in "\"'")):
                break
            at = nxt
        if name and (literals or names):
            yield name.strip("."), literals, names
        # a bare value may hold the next operator (a=b=c): its name may start right here
        floor = m.end()
        if literals and literals[-1][3]:
            floor = max(floor, at)


def literal_spans(text: str, threshold: float = THRESHOLD) -> list[tuple[int, int, str, float]]:
    """(start, end, target name, score) of literals that arrive at a sensitive name."""
    env: dict[str, _Value] = {}
    found: dict[tuple[int, int], tuple[str, float]] = {}
    for name, literals, names in assignments(text):
        links, own = [], list(literals)
        for ref, literal in names:
            known = env.get(ref) or env.get(ref.rsplit(".", 1)[-1])
            if known is not None:
                links.append(known)
            elif literal and not literals:
                own.append(literal)  # a bare word that names nothing known is a value, if it stands alone
        for _, _, word, _ in literals:
            if "$" in word:
                links += [env[n] for n in (a or b for a, b in _SHELL.findall(word)) if n in env]
        value = _Value(own, links)
        weight = name_weight(name)
        todo = [value] if weight else []
        while todo:
            v = todo.pop()
            if v.walked >= weight:
                continue
            v.walked = weight
            todo.extend(v.links)
            score = weight * literal_score("".join(x[2] for x in v.literals), all(x[3] for x in v.literals))
            for start, end, _, _ in v.literals:
                if score >= threshold and score > found.get((start, end), ("", 0.0))[1]:
                    found[start, end] = (name, score)
        env[name] = env[name.rsplit(".", 1)[-1]] = value
    return [(a, b, name, score) for (a, b), (name, score) in sorted(found.items())]


def spans(text: str, threshold: float = THRESHOLD) -> list[tuple[str, int, int, str | None, float]]:
    """(kind, start, end, name, score) by start and kind: the base's spans, and literals beside them."""
    base = base_spans(text)
    out = [(k, a, b, None, 1.0) for k, a, b in base]
    if extra := literal_spans(text, threshold):
        taken = sorted((a, b) for _, a, b in base)
        i = reach = 0
        for a, b, name, score in extra:
            while i < len(taken) and taken[i][0] < b:
                reach = max(reach, taken[i][1])
                i += 1
            if reach <= a:
                out.append(("literal", a, b, name, score))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def secrets(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per document: doc_id and ``found``, an array of (kind, start, end, name, score)."""
    def run(batches):
        for pdf in split(batches, 500):
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "found": [
                [dict(zip(("kind", "start", "end", "name", "score"), s)) for s in spans(t, threshold)] if isinstance(t, str) else []
                for t in pdf["text"]]})
    return docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(
        run, "doc_id long, found array<struct<kind string, start long, end long, name string, score double>>")


def span_list(found) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(found: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 (of the base's spans) and all spans."""
    def of(kind):
        return F.filter("found", lambda s: s["kind"] == kind)
    base = F.filter("found", lambda s: s["kind"] != "literal")
    return found.select("doc_id", *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in KINDS[:3]],
                        F.sha2(span_list(base).cast("binary"), 256).alias("base_sha256"), span_list("found").alias("spans"))
