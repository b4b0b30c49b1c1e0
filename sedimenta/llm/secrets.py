"""Secret scan: fixed patterns plus a token-efficiency test.

The fixed patterns find assignments, access keys and long hex strings. The test finds
random strings that no pattern names: a byte-pair vocabulary learnt from text needs many
tokens for them, so few characters per token give them away, whatever the case of their
letters, with or without digits. Digests, UUIDs, numbers and identifiers made of numbers
and of words that need few tokens are excluded, and what a fixed pattern already covers
is not reported again.

Defined cases: a null text counts as empty, which has no spans; spans count code points
and exclude their end; a text may be of any length (runs are encoded in slices and merged with
the fixed patterns' spans in one pass, so the work is linear); repeated rows give repeated results; an empty table gives an empty
result; columns other than the id and the text are not read.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame

from sedimenta.llm.common import map_texts

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# How the vocabulary's tokens are bounded within runs of letters, digits and signs.
PIECES = r"\p{L}+|\p{N}+|[^\s\p{L}\p{N}]+|\s+"
CHARS_PER_TOKEN = 2.0
SLICE = 256

# The patterns of the base spans, in the order of their kinds.
ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "random")

RUN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
DIGEST_CHARS = {32, 40, 48, 56, 64, 96, 128}
HEXADECIMAL = re.compile(r"[0-9a-fA-F]+\Z")
UUID = re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}\Z")
SIGNS = re.compile(r"[+/_=-]+")
PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

Span = tuple[int, int, int]


def base_spans(text: str) -> list[Span]:
    """(start, kind, end) of the fixed patterns, by start and kind."""
    spans: list[Span] = []
    if "=" in text or ":" in text:
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def n_tokens(run: str, tokens) -> int:
    return sum(len(tokens(run[i:i + SLICE])) for i in range(0, len(run), SLICE))


def is_known(run: str, tokens, limit: float) -> bool:
    """Digests, UUIDs, numbers, and identifiers of words and numbers of some length.

    A word is one token, or has ``limit`` characters per token.
    """
    if HEXADECIMAL.match(run) and (len(run) in DIGEST_CHARS or run.isdigit()) or UUID.match(run):
        return True
    bits = [x for x in SIGNS.split(run) if x]
    parts = PARTS.findall(run)
    if len(run) < 4 * len(parts) and not all(
            x.isdigit() or x.isalpha() and (x.islower() or x.isupper() or x.istitle()) for x in bits):
        return False
    return all(x.isdigit() or (n := n_tokens(x, tokens)) == 1 or len(x) >= limit * n for x in parts)


def random_spans(text: str, taken: Sequence[Span], tokens, limit: float) -> list[Span]:
    """``taken`` is in order of its starts; runs that it touches are left out."""
    spans, at, covered = [], 0, 0
    for m in RUN.finditer(text):
        run, start, end = m.group(), m.start(), m.end()
        # Spans that start before this run's end; what ends before its start touches no later run either.
        while at < len(taken) and taken[at][0] < end:
            covered = max(covered, taken[at][2])
            at += 1
        if covered > start:
            continue
        if len(run) < limit * n_tokens(run, tokens) and not is_known(run, tokens, limit):
            spans.append((start, 3, end))
    return spans


@functools.lru_cache(maxsize=2)
def _tokens(vocabulary: bytes):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in vocabulary.splitlines())}
    return tiktoken.Encoding("scan", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def joined(spans: Sequence[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str = VOCABULARY,
    chars_per_token: float = CHARS_PER_TOKEN,
) -> DataFrame:
    """One row per document: id, n_assign, n_access, n_hex, n_random, base_sha256, spans."""
    with open(vocabulary, "rb") as f:
        # A vocabulary file is under a megabyte or two whatever the corpus.
        shared = docs.sparkSession.sparkContext.broadcast(f.read())

    def start():
        tokens = _tokens(shared.value)

        def work(texts):
            columns = [[], [], [], [], [], []]
            for text in texts:
                text = text or ""
                base = base_spans(text)
                more = random_spans(text, base, tokens, chars_per_token)
                found = sorted(base + more) if more else base
                counts = [sum(kind == k for _, kind, _ in found) for k in range(4)]
                digest = hashlib.sha256(joined(base).encode()).hexdigest()
                for column, value in zip(columns, [*counts, digest, joined(found)]):
                    column.append(value)
            return columns

        return work

    fields = [(n, "long") for n in ("n_assign", "n_access", "n_hex", "n_random")]
    return map_texts(docs, [id_col], text_col, [*fields, ("base_sha256", "string"), ("spans", "string")], start)
