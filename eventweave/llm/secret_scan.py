"""Secret scans: fixed patterns, and strings that a primed compressor finds novel.

The patterns give the base spans. The novelty method looks at strings in a
sensitive place: strings of 12 characters or more that have a word such as
``password``, ``key`` or ``bearer`` among the ``AROUND`` characters before them,
over line ends too; the password of a URL that carries credentials; the body of
a private key block to its END line. Each candidate's cost is the growth, in
bytes, of a zstandard frame when the candidate is appended to its surroundings;
the compressor is primed with a dictionary of common identifiers and with the
surrounding text. Words, paths and names that the dictionary or the
surroundings know add few bytes; random strings add nearly their entropy and
are reported. A word of a language that the surroundings don't hold costs up to
0.85 bytes a character, random letters of both cases 0.9 and more, so strings
of letters or of digits alone, and such joined by _ or -, must cost
``PLAIN_MARGIN``, others ``MARGIN``.

A text is read in one pass per pattern: every stretch behind sensitive words is
searched once, spans are kept as sorted disjoint stretches, and BEGIN and END
lines are listed once.
"""

from __future__ import annotations

import itertools
import re
from bisect import bisect_right

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventweave.llm.spans import joined, runs, sha256
from eventweave.llm.tables import map_texts

KINDS = ["assign", "access", "hex", "novel"]

# The patterns of the base kinds.
_ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE = [
    runs(_ASSIGN, re.A | re.I, lambda m: m.end(2) - m.start(2) >= 12),
    runs(r"AKIA[A-Z0-9]{14,}"),
    runs(r"[0-9a-f]{16,}"),
]

# A sensitive word, and the candidate strings in what follows it.
_SENSITIVE = re.compile(
    r"(?:passw|pwd|passphrase|secret|token|credential|api[_-]?key|access[_-]?key|private[\x20_-]?key|"
    r"(?<![a-z])keys?(?![a-z])|auth|bearer|session|signature|client[_-]?id|connection[_-]?string)", re.A | re.I)
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=~!@#$%^&*-]{12,}")
_BLOCK = re.compile(r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----")
_BODY = re.compile(r"[A-Za-z0-9+/=\s\\]+")
_LOGIN = re.compile(r"://[^\s:/@?#]*+:([^\s/@]++)@")
AROUND = 400        # surrounding characters on each side: the compressor's, and a sensitive word's reach
MARGIN = 0.62       # marginal bytes a character from which a string counts as novel
PLAIN_MARGIN = 0.86     # of letters or of digits alone, joined by _ or - or not
_PLAIN = re.compile(r"(?:[A-Za-z_-]+|[0-9_-]+)")
_MARKS = re.compile(r"-----(BEGIN|END)")

# Identifiers that code and configuration use; they compress to little.
IDENTIFIERS = " ".join([
    "password passwd username user_name client_id client_secret access_token refresh_token api_key "
    "secret_key private_key public_key authorization bearer session_id csrf_token connection_string "
    "https http localhost example com org net www config settings environment variable default value "
    "import export function return class public static void string integer boolean true false null none "
    "abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 placeholder changeme your_token_here "
    "xxxxxxxxxxxxxxxxxxxxxxxx ################ ---------------- ================ ________________ "
    "BEGIN RSA PRIVATE KEY END CERTIFICATE ssh-rsa sha256 md5 base64 utf-8 application json content-type"]).encode()


def _novelty():
    import zstandard
    primed = zstandard.ZstdCompressor(
        level=9, dict_data=zstandard.ZstdCompressionDict(IDENTIFIERS, dict_type=zstandard.DICT_TYPE_RAWCONTENT),
        write_checksum=False, write_content_size=False)

    def marginal(text: str, a: int, b: int) -> float:
        """Marginal compressed bytes a character of text[a:b] after what surrounds it."""
        around = (text[max(0, a - AROUND):a] + "\n" + text[b:b + AROUND] + "\n").encode("utf-8", "replace")
        mine = text[a:b].encode("utf-8", "replace")
        return (len(primed.compress(around + mine)) - len(primed.compress(around))) / len(mine)
    return marginal


class _Stretches:
    """Disjoint stretches of a text, sorted."""

    def __init__(self, spans):
        self.starts, self.ends = [], []
        for a, b in sorted(spans):
            if self.ends and a <= self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], b)
            else:
                self.starts.append(a)
                self.ends.append(b)

    def meets(self, a: int, b: int) -> bool:
        k = bisect_right(self.ends, a)
        return k < len(self.starts) and self.starts[k] < b

    def add(self, a: int, b: int) -> None:
        """A stretch that meets none."""
        k = bisect_right(self.starts, a)
        self.starts.insert(k, a)
        self.ends.insert(k, b)


def _key_blocks(text: str):
    """The bodies of private key blocks, to their END line or as far as they look like one."""
    marks = [(m.start(), m[1]) for m in _MARKS.finditer(text)] if "-----BEGIN" in text else []
    places = [a for a, _ in marks]
    seen = 0
    for m in _BLOCK.finditer(text) if marks else ():
        if m.start() < seen:
            continue
        k = bisect_right(places, m.start())
        if k < len(marks) and marks[k][1] == "END":
            end = marks[k][0]
        else:                                                   # no END line of its own
            body = _BODY.match(text, m.end())
            end = body.end() if body else m.end()
        body, seen = text[m.end():end], end
        a = m.end() + len(body) - len(body.lstrip())
        if body.strip():
            yield a, a + len(body.strip())


def _near_words(text: str):
    """Candidate strings with a sensitive word among the characters before them."""
    searched = 0
    for word in _SENSITIVE.finditer(text):
        stop = word.end() + AROUND
        at = max(word.end(), searched)
        while at < stop and (m := _CANDIDATE.search(text, at, stop + 11)):
            m = _CANDIDATE.match(text, m.start())               # whole, beyond the stretch too
            yield m.span()
            at = m.end()
        searched = max(searched, at, stop)


def scan_text(text: str, marginal) -> tuple[list, list]:
    """Base and added spans of one text, each (start, kind number, end)."""
    base = [(a, k, b) for k, find in enumerate(BASE) for a, b in find(text)]
    # a block counts whole, though a pattern has a part of it
    blocks = [(a, b) for a, b in _key_blocks(text) if marginal(text, a, b) >= MARGIN]
    taken = _Stretches([(a, b) for a, _, b in base] + blocks)
    added = [(a, 3, b) for a, b in blocks]
    logins = (m.span(1) for m in _LOGIN.finditer(text)) if "://" in text else ()
    for a, b in itertools.chain(logins, _near_words(text)):
        least = PLAIN_MARGIN if _PLAIN.fullmatch(text, a, b) else MARGIN
        if not taken.meets(a, b) and marginal(text, a, b) >= least:
            taken.add(a, b)
            added.append((a, 3, b))
    return base, sorted(added)


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_assign, n_access, n_hex, base, spans): comma-joined kind:start:end.

    ``base`` has the pattern spans, ``spans`` also the novel ones. A null or
    empty text has none. Every row gives a row; repeated rows repeat, other
    columns are not read, an empty table gives an empty result.
    """
    def run(keys, texts):
        marginal = _novelty()
        counts, bases, alls = [], [], []
        for t in texts:
            base, added = scan_text(t, marginal) if t else ([], [])
            counts.append([sum(k == n for _, k, _ in base) for n in range(3)])
            bases.append(joined(base, KINDS))
            alls.append(joined(base + added, KINDS))
        return [keys, *(list(c) for c in (zip(*counts) if counts else ([], [], []))), bases, alls]

    out = map_texts(docs.withColumn(key, F.col(key).cast("long")), key, text, run,
                    f"{key} long, n_assign long, n_access long, n_hex long, base string, spans string")
    return out


def digests(docs: DataFrame) -> DataFrame:
    """The scan with ``base`` as its SHA-256."""
    return scan(docs).select("doc_id", "n_assign", "n_access", "n_hex",
                             F.sha2("base", 256).alias("base_sha256"), "spans")


__all__ = ["scan", "scan_text", "digests", "sha256"]
