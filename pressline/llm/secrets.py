"""Secret scan: fixed formats plus character Markov models of random strings and identifiers.

Two first-order Markov chains over characters, one trained on labelled random
strings, one on labelled ordinary words and identifiers, give each long token a
log-likelihood ratio per character. Tokens above a threshold, set on held-back
labelled samples, are reported as kind `random` beside the fixed formats.

The chains are two tables of CLASSES x CLASSES numbers; scanning is one narrow
pass over whole texts.
"""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_left
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressline.llm.words import arrow_map, raw, sampled_texts, texts_of

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII)
#: A text without one of these cannot hold an assignment.
WORDS = ("passw", "secret", "token", "api")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
MIN_VALUE, MIN_ACCESS, MIN_HEX = 6, 20, 24
#: Tokens that the Markov models judge.
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
CLASSES = 66
#: Labelled samples of each class for training, and documents that ordinary words come from.
SAMPLES, SAMPLE_DOCS = 4000, 500

#: Labelled ordinary words beside those of the corpus.
ORDINARY = (
    "account action active address amount array audio backup block bottom buffer button cache callback category center channel character check child class client close color column command comment common compare config connection console content context"
    " control count create current custom data database date default delete description design device directory display document domain download driver element email enable encode engine entry error event example export field file filter folder font form"
    " format frame function group handle header height history host image import index info initial input insert install instance integer internal invalid item language layout length level library limit line list load local location manager market match"
    " maximum memory menu message method middle minimum model module mouse name network node number object option order output package page parameter parent password path pattern payment performance picture point port position previous price print process"
    " product profile program project property public query question queue random range record reference region report request reset resource response result return root schedule screen script search section select send server service session setting shape"
    " signal simple size source space start state status storage stream string structure style submit support switch system table target template text thread time title token toggle total track transaction transfer type update upload user value variable vector version view visible volume width window word write"
).split()

_ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_="
CODE = np.full(128, CLASSES - 1, np.int64)
for _i, _c in enumerate(_ALPHABET[: CLASSES - 1]):
    CODE[ord(_c)] = _i


def random_strings(n: int, seed: int = 1) -> list[str]:
    """Labelled sample of class 1: keys in the usual alphabets."""
    rng = random.Random(seed)
    kinds = ("0123456789abcdef", "abcdefghijklmnopqrstuvwxyz0123456789", _ALPHABET[:62], _ALPHABET[:62] + "+/", _ALPHABET[26:62])
    return ["".join(rng.choices(kinds[i % len(kinds)], k=rng.randint(20, 48))) for i in range(n)]


def identifiers(words: list[str], n: int, seed: int = 2) -> list[str]:
    """Labelled sample of class 0: words joined the way code and file names join them, and ruled lines."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        parts: list[str] = []
        while sum(map(len, parts)) < 20:
            parts.append(rng.choice(words))
        joined = ("_".join(parts), "-".join(parts), "".join(p.capitalize() for p in parts), "".join(parts), "/".join(parts), rng.choice("-=_+/ax0") * rng.randint(20, 60))[i % 6]
        out.append(joined + (str(rng.randint(0, 2030)) if i % 4 == 0 else ""))
    return out


class Markov:
    """log P(next | previous) of random strings minus that of ordinary ones."""

    def __init__(self, positive: list[str], negative: list[str]):
        self.table = self._chain(positive) - self._chain(negative)

    @staticmethod
    def codes(s: str) -> np.ndarray:
        return CODE[np.minimum(np.frombuffer(s.encode("ascii", "replace"), np.uint8), 127)]

    @classmethod
    def _chain(cls, samples: list[str]) -> np.ndarray:
        counts = np.full((CLASSES, CLASSES), 0.1)
        for s in samples:
            c = cls.codes(s)
            np.add.at(counts, (c[:-1], c[1:]), 1.0)
        return np.log(counts / counts.sum(1, keepdims=True))

    def ratio(self, s: str) -> float:
        c = self.codes(s)
        return float(self.table[c[:-1], c[1:]].mean()) if len(c) > 1 else 0.0


def trained(words: list[str]) -> tuple[np.ndarray, float]:
    """(table, threshold): the midpoint between the classes' tails on held-back samples."""
    positive, negative = random_strings(SAMPLES), identifiers([*ORDINARY, *words], SAMPLES)
    cut = SAMPLES * 3 // 4
    model = Markov(positive[:cut], negative[:cut])
    low = float(np.quantile([model.ratio(s) for s in positive[cut:]], 0.01))
    high = float(np.quantile([model.ratio(s) for s in negative[cut:]], 0.999))
    return model.table, max(high, (low + high) / 2)


def ordinary_words(docs: DataFrame, text_col: str = "text", most: int = SAMPLE_DOCS) -> list[str]:
    """Distinct lower-case words of the `most` distinct texts of smallest hash, sorted."""
    sample = sampled_texts(docs, most, 3, text_col)
    words = sample.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower("t"), F.lit("[a-z]{3,}"), 0))).alias("w"))
    return sorted(r.w for r in words.distinct().orderBy(F.xxhash64("w"), "w").limit(SAMPLES).collect())


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed formats, in code points."""
    out = []
    low = text.lower()
    if any(w in low for w in WORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_VALUE]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def added_spans(text: str, base: list[tuple[int, int, int]], table: np.ndarray, threshold: float) -> list[tuple[int, int, int]]:
    """Tokens that read like random strings and touch no base span."""
    out = []
    starts = [s for s, _, _ in base]
    ends = list(accumulate((e for _, _, e in base), max))
    for m in TOKEN.finditer(text):
        before = bisect_left(starts, m.end())
        if before and ends[before - 1] > m.start():
            continue
        c = Markov.codes(m[0])
        if table[c[:-1], c[1:]].mean() > threshold:
            out.append((m.start(), 3, m.end()))
    return out


def _said(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: list[str] | None = None) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random.

    A null or empty text has no spans and the digest of the empty string, an empty table gives
    no rows. Repeated rows and null ids are scanned each, texts of any length whole. Matches
    that fail a length test are dropped and their text is not searched again. Spans of several
    kinds may overlap; equal starts go by kind. A random token that touches a base span is not
    added. Only the two named columns are read, so other columns may have any name.
    """
    table, threshold = trained(ordinary_words(docs, text_col) if words is None else words)
    kind = dict(docs.dtypes)[id_col]

    def scanned(batches):
        for batch in batches:
            base, every = [], []
            for data in texts_of(batch.column(1)):
                text = data.decode("utf-8", "replace")
                found = base_spans(text)
                base.append(found)
                every.append(sorted(found + added_spans(text, found, table, threshold)))
            count = lambda rows, k: pa.array([sum(1 for x in r if x[1] == k) for r in rows], pa.int64())
            digests = pa.array([hashlib.sha256(_said(b).encode()).hexdigest() for b in base])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), count(base, 0), count(base, 1), count(base, 2), digests, pa.array([_said(e) for e in every], pa.string()), count(every, 3)],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random"],
            )

    return arrow_map(docs.select(F.col(id_col).alias("doc_id"), raw(text_col).alias("data")), scanned, f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_random long")
