"""Secret scans: plain patterns, and assignments read as name-literal pairs.

A text is lexed around its assignment signs into (name, expression). Expressions are
literals, names of earlier constants, and sums of both; a literal is scored by the words of
the names that it reaches, directly or through constants, and by its form.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed patterns of the plain scan.
ASSIGN = re.compile(r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                    r"""([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")

KINDS = ["assign", "access", "hex", "literal", "constant"]

# Words of names that hold secrets, with their weight.
SENSITIVE = {"password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "secret": 1.0,
             "token": 0.9, "apikey": 1.0, "credential": 0.9, "credentials": 0.9, "auth": 0.6,
             "bearer": 0.8, "private": 0.6, "access": 0.4, "api": 0.4, "key": 0.5, "salt": 0.5,
             "signing": 0.5, "encryption": 0.5}
PLACEHOLDER = re.compile(r"(?i)(example|changeme|placeholder|dummy|your|xxx|todo|<.*>|\$\{.*\}"
                         r"|null|none|true|false)")
LEAST_SCORE = 0.9

SIGN = re.compile(r":=|=>|==+|!=|<=|>=|[=:]")
STRING = re.compile(r'"((?:[^"\\\n]|\\[^\n])*)"|\'((?:[^\'\\\n]|\\[^\n])*)\'')
BARE = re.compile(r"[A-Za-z0-9+/_.=\-]+")
NAME = re.compile(r"[A-Za-z_][\w.\-]*")
WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")


def plain_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, rank of kind, end) of the plain patterns, leftmost and non-overlapping."""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    return spans + [(m.start(), 2, m.end()) for m in HEX.finditer(text)]


def assignments(text: str) -> Iterator[tuple[str, list[tuple[str, int, int]]]]:
    """(name, parts) per assignment; a part is ("literal" or "name", start, end).

    The name is the identifier before the sign, on the same line; the search for it never
    goes back beyond the sign before, so a text is read once.
    """
    last = 0
    for sign in SIGN.finditer(text):
        if sign.group() not in ("=", ":", ":=", "=>"):
            last = sign.end()
            continue
        at = sign.start()
        while at > last and text[at - 1] in " \t\"']":
            at -= 1
        start = at
        while start > last and (text[start - 1].isalnum() or text[start - 1] in "_-."):
            start -= 1
        last = sign.end()
        name = text[start:at]
        if NAME.fullmatch(name):
            parts = list(_expression(text, sign.end()))
            if parts:
                yield name, parts


def _expression(text: str, at: int) -> Iterator[tuple[str, int, int]]:
    while True:
        while at < len(text) and text[at] in " \t":
            at += 1
        if m := STRING.match(text, at):
            yield "literal", at + 1, m.end() - 1
        elif m := BARE.match(text, at):
            yield "name" if NAME.fullmatch(m.group()) else "literal", at, m.end()
        else:
            return
        at = m.end()
        while at < len(text) and text[at] in " \t":
            at += 1
        if at >= len(text) or text[at] != "+":
            return
        at += 1


def sensitivity(name: str) -> float:
    """Weight of a name: the greatest word weight, or the sum of key-like pairs, up to 1."""
    weights = [SENSITIVE.get(w.lower(), 0.0) for w in WORD.findall(name)]
    joined = SENSITIVE.get("".join(c for c in name.lower() if c.isalnum()), 0.0)
    return min(1.0, max([joined, sum(weights)]))


def form(literal: str) -> float:
    """0 to 1 by length, mixed signs and entropy; 0 for placeholders."""
    if len(literal) < 6 or " " in literal or PLACEHOLDER.search(literal):
        return 0.0
    n = len(literal)
    bits = -sum(c / n * math.log2(c / n) for c in Counter(literal).values())
    kinds = sum(bool(re.search(p, literal)) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
    return min(1.0, 0.2 + 0.1 * kinds + 0.15 * bits)


@dataclass
class Given:
    """What a name was given: literals, and what other names held at that time."""

    spans: list[tuple[int, int]]
    sums: list[Given]
    weight: float = 0.0     # the greatest that has reached it

    def reached(self, weight: float) -> Iterator[tuple[int, int]]:
        """All literals below that no name of this weight has reached before, each once.

        There are few weights, so all names together visit a text's literals few times.
        """
        todo = [self]
        while todo:
            given = todo.pop()
            if given.weight < weight:
                given.weight = weight
                yield from given.spans
                todo += given.sums


def scored_spans(text: str) -> list[tuple[int, int, str, float]]:
    """(start, end, kind, score) of literals that reach a sensitive name.

    "literal": the name itself is sensitive; "constant": the literal was given to another
    name first, which a sensitive name then takes over, alone or in a sum.
    """
    constants: dict[str, Given] = {}
    best: dict[tuple[int, int], tuple[float, str]] = {}

    def rate(a: int, b: int, score: float, kind: str) -> None:
        if score >= LEAST_SCORE - 0.4 and score > best.get((a, b), (0.0, ""))[0]:
            best[a, b] = score, kind

    for name, parts in assignments(text):
        weight, given = sensitivity(name), Given([], [])
        for kind, start, end in parts:
            known = constants.get(text[start:end]) if kind == "name" else None
            if known is None:
                given.spans.append((start, end))
                if weight:
                    score = weight * form(text[start:end])
                    if kind == "name":
                        score *= len(set("0123456789") & set(text[start:end])) > 0
                    rate(start, end, score, "literal")
            else:
                given.sums.append(known)
                for a, b in known.reached(weight):
                    rate(a, b, weight * form(text[a:b]), "constant")
        constants[name] = given
    return [(a, b, kind, score) for (a, b), (score, kind) in best.items()]


def _scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = []
        for text in batch["text"]:
            text = "" if text is None else text
            plain = plain_spans(text)
            more = scored_spans(text) if "=" in text or ":" in text else []
            spans = plain + [(a, KINDS.index(kind), b) for a, b, kind, _ in more]
            scores = {(a, KINDS.index(kind), b): score for a, b, kind, score in more}
            found.append([{"kind": KINDS[k], "start": a, "end": b, "literal": text[a:b],
                           "score": scores.get((a, k, b), 1.0)} for a, k, b in sorted(spans)])
        yield pd.DataFrame({"doc_id": batch["doc_id"], "secrets": found})


SECRETS = "array<struct<kind string, start bigint, end bigint, literal string, score double>>"


def scan(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, secrets) per row: all spans by start, then kind, in code points.

    A null text is empty; repeated rows and null keys are scanned like all others. Rows
    never meet, so there is no shuffle and skewed keys do not matter.
    """
    kind = df.schema[key].dataType.simpleString()
    return df.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).mapInPandas(
        _scan, f"doc_id {kind}, secrets {SECRETS}").withColumnRenamed("doc_id", key)
