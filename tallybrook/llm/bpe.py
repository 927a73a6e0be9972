"""BPE as a bounded-lookahead streaming transducer, and decoding byte by byte.

Encoding reads the symbols of a word from left to right.  For every prefix it
keeps one thing: the last token of the prefix's encoding, found as the longest
token that ends there and may follow the token before it.  Two tokens may stand
side by side unless some merge would have joined pieces across their seam
before either piece was used up.  The merge list bounds how far to the right a
decision can depend on the input (``lookahead``); a token that ends so far
behind the reading point is stable and is emitted, and the state before it is
dropped.  Memory is constant in the length of the word.

A NULL or empty text has no tokens and decodes to the empty text.
"""

from __future__ import annotations

import codecs
import json
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache
from os.path import commonprefix

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from tallybrook.llm.common import sliced, worker_cache
from tallybrook.llm.tokens import Pieces

END = 0x1000  # added to the code of a symbol that ends a word
NEVER = 1 << 60
LIMIT = 300_000
KEPT = 700_000  # pieces of text whose ids a worker keeps
HEAD = 6  # symbols whose state is kept for the next word that begins with them


def byte_symbols() -> list[str]:
    """The printable character of each byte: itself where it is a visible
    character of Latin-1, else the next free one from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    free = iter(range(256, 512))
    return [chr(b if b in visible else next(free)) for b in range(256)]


class Transducer:
    """Encoder and decoder of a model file with byte-level symbols and,
    optionally, a suffix that marks the end of a word."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.text_of = {i: t for t, i in model["vocab"].items()} | {i: t for t, i in self.special.items()}
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(split["pattern"]["Regex"])
        self.cut = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.mark = commonprefix(list(self.special))  # a text without it holds no special token
        merges = [(self._symbols(a), self._symbols(b)) for a, b in model["merges"]]
        self.rank = {pair: r for r, pair in enumerate(merges)}
        self.parts = {a + b: (a, b) for a, b in merges}
        self.born = {a + b: r for r, (a, b) in enumerate(merges)}
        names = {self._symbols(t): i for t, i in model["vocab"].items() if t not in self.special}
        # a token that its own parts would not form can never come out
        self.ids = {t: i for t, i in names.items() if t not in self.parts or self._forms(t)}
        self.longest = max(map(len, self.ids))
        # lengths of the tokens that end in the same three symbols, longest first
        ends: dict[str, set[int]] = {}
        for t in self.ids:
            if len(t) > 2:
                ends.setdefault(t[-3:], set()).add(len(t))
        self.ends = {e: (*sorted(n, reverse=True), 2, 1) for e, n in ends.items()}
        self.lookahead = sufficient_lookahead(merges)
        self.may_follow = lru_cache(LIMIT)(self._may_follow)
        self.begun: dict[str, list[str]] = {}
        self.name_of = {i: t.encode("utf-8") for i, t in self.text_of.items()}
        self.decoder = codecs.getincrementaldecoder("utf-8")
        self.symbols = byte_symbols()
        self.byte = {c: b for b, c in enumerate(self.symbols)}

    def _symbols(self, token: str) -> str:
        if self.suffix and token.endswith(self.suffix):
            body = token[: -len(self.suffix)]
            return body[:-1] + chr(ord(body[-1]) + END)
        return token

    def _forms(self, token: str) -> bool:
        a, b = self.parts[token]
        born = self.born[token]
        return born > max(self.born.get(a, -1), self.born.get(b, -1)) and not self._joined(a, b, born)

    def _spine(self, token: str, side: int) -> Iterator[tuple[str, int]]:
        """Pieces of a token that touch its left (0) or right (1) end, each with
        the rank of the merge that uses it up."""
        until = NEVER
        while True:
            yield token, until
            if token not in self.parts:
                return
            until, token = self.born[token], self.parts[token][side]

    def _joined(self, left: str, right: str, before: int = NEVER) -> bool:
        """Whether some merge joins pieces across the seam of two tokens.  Of equal
        ranks the one further left goes first."""
        rights = list(self._spine(right, 0))
        for x, x_until in self._spine(left, 1):
            for y, y_until in rights:
                r = self.rank.get((x, y), NEVER)
                if r < x_until and r <= y_until and r < before:
                    return True
        return False

    def _may_follow(self, left: str, right: str) -> bool:
        return not self._joined(left, right)

    def tokens(self, symbols: Iterable[str]) -> Iterator[str]:
        """Tokens of one word, each as soon as it is stable."""
        hold = self.lookahead + self.longest
        text, last = "", [""]  # the window's symbols; the last token of each prefix
        for c in symbols:
            text += c
            i = len(text)
            for start in range(max(0, i - self.longest), i):
                t = text[start:]
                if t in self.ids and (not last[start] or self.may_follow(last[start], t)):
                    last.append(t)
                    break
            else:
                last.append("")
            if i >= 2 * hold and i % hold == 0:
                stable, at = [], i
                while at:
                    if at <= i - self.lookahead:
                        stable.append(last[at])
                    at -= len(last[at])
                if len(stable) > 1:  # the last stable one stays as left neighbour
                    yield from reversed(stable[1:])
                    gone = sum(map(len, stable[1:]))
                    text, last = text[gone:], ["", *last[gone + 1 :]]
                    at = len(stable[0])
                    last[at] = stable[0]
                    # prefixes that end inside the kept token are no longer needed
        out, at = [], len(text)
        while at:
            out.append(last[at])
            at -= len(last[at])
        yield from reversed(out)

    def word_ids(self, symbols: str) -> list[int]:
        """Ids of one word."""
        if symbols in self.ids:
            return [self.ids[symbols]]
        short = len(symbols) < 2 * (self.lookahead + self.longest)
        return [self.ids[t] for t in (self._short(symbols) if short else self.tokens(symbols))]

    def _short(self, word: str) -> list[str]:
        """Tokens of a word that ends before anything could be emitted."""
        ids, lengths, may_follow = self.ids, self.ends.get, self.may_follow
        # what a prefix leads to does not depend on what follows it
        head = word[:HEAD] if len(word) > HEAD else ""
        last = self.begun.get(head)
        known = last is not None
        last = last.copy() if known else [""]
        for i in range(len(last), len(word) + 1):
            if i == HEAD + 1 and not known:
                if len(self.begun) > LIMIT:
                    self.begun.clear()
                self.begun[head] = last.copy()
            for n in lengths(word[i - 3 : i], (2, 1)) if i > 2 else (2, 1):
                start = i - n
                if start >= 0:
                    t = word[start:i]
                    if t in ids and (not start or may_follow(last[start], t)):
                        last.append(t)
                        break
        out, at = [], len(word)
        while at:
            out.append(last[at])
            at -= len(last[at])
        return out[::-1]

    def word_symbols(self, word: str) -> str:
        s = "".join([self.symbols[b] for b in word.encode("utf-8", "replace")])
        return s[:-1] + chr(ord(s[-1]) + END) if self.suffix else s

    def encode(self, text: str) -> list[int]:
        """Ids of a text; strings of special tokens in it count as those tokens."""
        if not self.cut or self.mark not in text:
            return self._plain(text)
        out: list[int] = []
        at = 0
        for m in self.cut.finditer(text):
            out += self._plain(text[at : m.start()])
            out.append(self.special[m.group()])
            at = m.end()
        return out + self._plain(text[at:])

    def _plain(self, text: str) -> list[int]:
        if text.isascii():
            text = text.lower()
            if self.suffix and text.isalpha():
                return self.word_ids(text[:-1] + chr(ord(text[-1]) + END))
        else:
            text = "".join([c.lower() for c in unicodedata.normalize("NFC", text)])
        return [i for w in self.words.findall(text) for i in self.word_ids(self.word_symbols(w))]

    def decoded(self, ids: Iterable[int], tokens: bool = False) -> Iterator[str]:
        """The text of a stream of ids, character by character as its bytes become
        complete; broken bytes become U+FFFD.  A word's end becomes a space.

        With ``tokens`` the bytes are those of the tokens' own names, one space between
        two: the library's decode where the file names no decoder.
        """
        machine = self.decoder("replace")
        if tokens:
            between = b""
            for i in ids:
                yield machine.decode(between + self.name_of[i])
                between = b" "
            return
        for i in ids:
            token = self.text_of[i]
            if token in self.special:
                yield machine.decode(b"", True) + token
                machine.reset()
                continue
            ends = bool(self.suffix) and token.endswith(self.suffix)
            body = token[: -len(self.suffix)] if ends else token
            yield machine.decode(bytes([self.byte[c] for c in body])) + (machine.decode(b"", True) + " " if ends else "")
        yield machine.decode(b"", True)


def sufficient_lookahead(merges: list[tuple[str, str]]) -> int:
    """Symbols to the right of a boundary on which it can depend.

    Whether a merge (a, b) happens depends on whether an earlier merge took away
    a suffix of b, and on whatever that one depended on.  Going through the
    merges by rank, ``reach[x]`` is the longest such dependence of the merges
    so far whose left part is x, from the end of x on.
    """
    reach: dict[str, int] = {}
    most = 0
    for a, b in merges:
        d = len(b) + max(reach.get(b[i:], 0) for i in range(len(b)))
        reach[a] = max(reach.get(a, 0), d)
        most = max(most, d)
    return most


class _Known(Pieces):
    """What a worker knows of pieces of text; the decimals of ids and what they show."""

    def __init__(self, path: str):
        super().__init__()
        self.machine = Transducer(path)
        every = range(max(self.machine.name_of) + 1)
        self.decimals = pa.array(map(str, every), pa.large_string())
        self.shown = pa.array(["".join(self.machine.decoded([i], tokens=True)) if i in self.machine.name_of else None for i in every], pa.large_string())

    def look_up(self, pieces: list[str]) -> np.ndarray:
        """The number of each of some distinct pieces; new ones are encoded."""
        if len(self.known) > KEPT:
            self.forget()
        number = list(map(self.known.get, pieces))
        new = [p for p, n in zip(pieces, number) if n is None]
        if not new:
            return np.array(number, np.int64)
        ids, lengths = [], []
        for p in new:
            found = self.machine.encode(p)
            ids += found
            lengths.append(len(found))
        self.add(new, np.array(ids, np.uint32), np.array(lengths))
        return np.fromiter(map(self.known.__getitem__, pieces), np.int64, len(pieces))


def known(path: str) -> _Known:
    return worker_cache(f"transducer {path}", lambda: _Known(path))


def round_trip(docs: DataFrame, path: str, digests: bool = False) -> DataFrame:
    """Per document the ids (decimal, joined by spaces) and the decoded text, or
    with ``digests`` the SHA-256 of both.

    Returns doc_id, n_tokens and ids, decoded (or ids_sha256, decoded_sha256);
    rows stay where they are, so no key can be hot.  Other columns of the input
    are not read; a repeated doc_id gives a row each time.
    """
    import hashlib

    def digest(texts: pa.Array) -> list[str]:
        return [hashlib.sha256(b).hexdigest() for b in texts.cast(pa.large_binary()).to_pylist()]

    def encode(batches):
        of = known(path)
        for batch in sliced(batches, "text", 8 << 20):
            texts = pc.fill_null(batch.column("text").cast(pa.large_string()), "")
            # white space and a stop or comma after a letter always part tokens
            cut = pc.replace_substring_regex(texts, "([A-Za-zà-öø-ÿ])([.,])", r"\1 \2")
            lists = pc.ascii_split_whitespace(cut)
            coded = lists.flatten().dictionary_encode()
            number = of.look_up(coded.dictionary.to_pylist())
            ids, at = of.ids_of(number[coded.indices.to_numpy()])
            total = at[lists.offsets.to_numpy()]
            joined = [
                pc.binary_join(pa.LargeListArray.from_arrays(pa.array(total), part.take(pa.array(ids))), pa.scalar(" ", pa.large_string()))
                for part in (of.decimals, of.shown)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(total)), *(pa.array(digest(j)) if digests else j.cast(pa.string()) for j in joined)],
                names=names,
            )

    names = ["doc_id", "n_tokens", *(["ids_sha256", "decoded_sha256"] if digests else ["ids", "decoded"])]
    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(encode, f"doc_id {kind}, n_tokens bigint, {names[2]} string, {names[3]} string")
