"""Exact token counts of every prefix of a text, by dynamic programming over a byte-level BPE.

The tokens of a piece of text (what the byte-level rule cuts texts into before
merging) follow from the tokens of its prefixes: exactly one token ends at a
position and is left alone beside the last token of the prefix before it, and the
prefix has one token more than that one. An automaton of the vocabulary lists the
tokens that end at each position, and two tokens leave each other alone if none of
the merges along their border comes before those that built the two. So one pass
gives the count at every position, with no text encoded and none encoded again:
what a budget of tokens holds, or what a cut costs, is looked up.

Prefixes are counted in code points, and each count is the one the tokenizer gives
for that prefix as a text of its own. A white-space run at the end of a prefix is one
piece, although the longer text may cut it; the strings of special tokens count as one
token once they are complete. Pieces never cross words, so counts of words already
seen are kept, in two generations of bounded size.

Null texts count as empty, with no token; null and repeated ids give one row for each
row of the table. An empty table gives an empty result, extra columns are ignored.
Texts of any length are taken whole; only counts, four bytes a code point, are held
beside the text.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayline.llm.common import utf8, worker_state
from quayline.session import configure

LIMIT = 512
#: Words whose counts a generation keeps, and the longest such word.
CACHED, LONGEST = 400_000, 64

# Characters with the Unicode property White_Space.
_ASCII_WHITE, _OTHER_WHITE = r" \t\n\r\x0b\x0c", r"\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# The byte-level rule for ASCII and Latin letters; words with other characters are cut by the tokenizer's own.
_LATIN = r"A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_PIECE = re.compile(rf"'(?:s|t|re|ve|m|ll|d)| ?[{_LATIN}]+| ?[0-9]+| ?[^\s0-9{_LATIN}]+|\s+(?!\S)|\s+", re.ASCII)
_PLAIN = re.compile(rf"[\x00-\x7f{_LATIN}]*")
_LONG_ENDING = ("'re", "'ve", "'ll")
_RUN = re.compile(f"[{_ASCII_WHITE}{_OTHER_WHITE}]+")
# No piece crosses a cut before ASCII white space, nor one between an ASCII letter and ASCII punctuation.
_WORD = re.compile(rf"[{_ASCII_WHITE}]*+(?:[A-Za-z]++(?=[!-&(-/:-@\[-`{{-~])|[^{_ASCII_WHITE}]++)|[{_ASCII_WHITE}]++")
# With other white space beside it such a cut may fall into a run: these texts are one word.
_WHOLE = re.compile(f"[{_OTHER_WHITE}]")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary.

    Printable Latin-1 characters stand for themselves, the other bytes follow from 256 on.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class _Counts(dict):
    """Token counts of words or pieces; the generation before the last is dropped when a new one starts."""

    def __init__(self, count):
        super().__init__()
        self.count, self.old = count, {}

    def __missing__(self, text: str) -> int:
        if len(self) >= CACHED:
            self.old = dict(self)
            self.clear()
        found = self.old.get(text)
        if found is None:
            found = self.count(text)
        if len(text) <= LONGEST:
            self[text] = found
        return found


def _bytes(text: str) -> str:
    """A character for each byte of the text."""
    return text if text.isascii() else text.encode().decode("latin-1")


class PrefixCounter:
    """Token counts by the merges of a byte-level BPE file."""

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        file = json.loads(vocabulary)
        model, pre = file["model"], file["pre_tokenizer"] or {}
        plain = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
        odd = [k for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges") if model.get(k)]
        if model["type"] != "BPE" or not plain or odd or file.get("normalizer"):
            raise ValueError("prefix counts need a plain byte-level BPE")
        special = file["added_tokens"]
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in special):
            raise ValueError("special tokens that take white space or whole words are not supported")
        # A longer special string wins over its own beginning.
        strings = sorted((t["content"] for t in special), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, strings))) if strings else None
        self.cut = Tokenizer.from_str(vocabulary).pre_tokenizer.pre_tokenize_str
        self._read(model)
        #: For each token the ones that may follow it or not, as far as known.
        self.fits: dict[int, dict[int, bool]] = {}
        self.known = 0
        self.words, self.pieces = _Counts(self._word), _Counts(lambda piece: self.prefixes_of_piece(_bytes(piece))[-1])

    def _read(self, model: dict) -> None:
        ids, letters = model["vocab"], byte_letters()
        size = max(ids.values()) + 1
        #: When a token is built (bytes: before all merges), from which two, and what two build.
        self.size, self.built, self.left, self.right = size, [-1] * size, [-1] * size, [-1] * size
        self.merge: dict[int, int] = {}
        self.tokens = ahocorasick.Automaton()
        for text, token in ids.items():
            if len(text) == 1 and text in letters:
                self.tokens.add_word(chr(letters[text]), (1, token))
        for at, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            token = ids[a + b]
            self.merge.setdefault(ids[a] * size + ids[b], at)
            if self.built[token] < 0:
                self.built[token], self.left[token], self.right[token] = at, ids[a], ids[b]
                self.tokens.add_word("".join(chr(letters[c]) for c in a + b), (len(a + b), token))
        self.tokens.make_automaton()

    def stay_apart(self, one: int, two: int) -> bool:
        """Whether a text of these two tokens is encoded as these two.

        Looks at the pairs that ever met at the border, from the last to the first: a pair
        would have been merged if its merge comes before what became of its two sides.
        Equal merges run from left to right.
        """
        built, merge, never = self.built, self.merge, len(self.merge) + 1
        gone_one = gone_two = never
        while True:
            at = merge.get(one * self.size + two, never)
            if at < gone_one and at <= gone_two and at < never:
                return False
            if built[one] < 0 and built[two] < 0:
                return True
            if built[one] > built[two]:
                gone_one, one = built[one], self.right[one]
            else:
                gone_two, two = built[two], self.left[two]

    def _follows(self, one: int, two: int, row: dict[int, bool]) -> bool:
        if self.known >= 4 * CACHED:
            for other in self.fits.values():
                other.clear()
            self.known = 0
        self.known += 1
        row[two] = fit = self.stay_apart(one, two)
        return fit

    def prefixes_of_piece(self, piece: str) -> list[int]:
        """Token counts at every byte of one piece, given with a character for each byte; the first is 0."""
        last, counts, rows = [0] * (len(piece) + 1), [0] * (len(piece) + 1), [None] * (len(piece) + 1)
        fits = self.fits
        for end, (length, token) in self.tokens.iter(piece):
            end += 1
            if counts[end]:
                continue
            start = end - length
            if start:
                row = rows[start]
                if row is None:
                    row = rows[start] = fits.setdefault(last[start], {})
                fit = row.get(token)
                if fit is None:
                    fit = self._follows(last[start], token, row)
                if not fit:
                    continue
            last[end], counts[end] = token, counts[start] + 1
        return counts

    def _characters(self, text: str) -> list[int]:
        """Token counts after every character of one piece."""
        if text.isascii():
            return self.prefixes_of_piece(text)[1:]
        raw = text.encode()
        at = self.prefixes_of_piece(_bytes(text))
        # A character ends where the next one begins.
        return [at[i] for i in range(1, len(raw)) if raw[i] & 0xC0 != 0x80] + [at[-1]]

    def _word(self, word: str) -> int:
        """The tokens of a text without special strings."""
        pieces = _PIECE.findall(word) if _PLAIN.fullmatch(word) else [word[a:b] for _, (a, b) in self.cut(word)]
        return sum(map(self.pieces.__getitem__, pieces))

    def prefixes_of_word(self, word: str) -> list[int]:
        """Token counts after every character of a text without special strings."""
        spans = [m.span() for m in _PIECE.finditer(word)] if _PLAIN.fullmatch(word) else [span for _, span in self.cut(word)]
        out: list[int] = []
        base = run_end = 0
        for start, end in spans:
            piece = word[start:end]
            if start >= run_end and (run := _RUN.match(word, start)):
                # As the end of a prefix, white space is one piece from where it begins.
                run_end = run.end()
                out += [base + c for c in self._characters(run[0])]
            counts = self._characters(piece)
            if piece in _LONG_ENDING:
                counts[1] = 2  # a quote and a letter while the ending is not complete
            out += [base + c for c in counts[len(out) - start :]]
            base += counts[-1]
        return out

    def _parts(self, text: str) -> Iterator[tuple[str, str]]:
        """Stretches of plain text, each with the special string behind it."""
        at = 0
        if self.special:
            for m in self.special.finditer(text):
                yield text[at : m.start()], m[0]
                at = m.end()
        yield text[at:], ""

    @staticmethod
    def _split(text: str) -> list[str]:
        return _WORD.findall(text) if text.isascii() or not _WHOLE.search(text) else [text]

    def total(self, text: str) -> int:
        """The number of tokens of a text."""
        if self.special and self.special.search(text):
            return sum(self.total(part) + bool(string) for part, string in self._parts(text))
        return sum(map(self.words.__getitem__, self._split(text)))

    def prefixes(self, text: str) -> np.ndarray:
        """Token counts of ``text[:0]``, ``text[:1]`` and so on up to the whole text."""
        out, base = [np.zeros(1, dtype=np.int32)], 0
        for part, string in self._parts(text):
            # Up to its last character a special string is text like any other.
            plain, end = part + string[:-1], base
            for word in self._split(plain):
                counts = self.prefixes_of_word(word)
                out.append(np.array(counts, dtype=np.int32) + end)
                end += counts[-1]
            base += self.total(part)
            if string:
                base += 1
                out.append(np.array([base], dtype=np.int32))
        return np.concatenate(out)

    def longest(self, text: str, budget: int) -> tuple[int, int]:
        """The longest prefix of at most ``budget`` tokens, in code points, and its tokens."""
        total = self.total(text)
        if total <= budget:
            return len(text), total
        if self.special and self.special.search(text):
            return longest_prefix(self.prefixes(text), budget)
        words = self._split(text)
        ends = np.cumsum(np.fromiter(map(self.words.__getitem__, words), dtype=np.int64, count=len(words)))
        # A word has a token at least, so nothing behind the first word end over the budget is within it.
        over = int(np.searchsorted(ends, budget, side="right"))
        base = int(ends[over - 1]) if over else 0
        inside = [0, *self.prefixes_of_word(words[over])]
        best = max((i for i, c in enumerate(inside) if base + c <= budget), default=0)
        return sum(map(len, words[:over])) + best, base + inside[best]


def longest_prefix(counts: np.ndarray, budget: int) -> tuple[int, int]:
    """The last position whose count is within ``budget``, and its count; counts may fall from one position to the next."""
    at = int(np.flatnonzero(counts <= budget)[-1])
    return at, int(counts[at])


def pack(counts: np.ndarray) -> bytes:
    """The counts as compressed steps: most steps are 0 or 1, a few fall."""
    return zlib.compress(np.diff(counts).astype("<i2").tobytes(), 1)


def unpack(packed: bytes) -> np.ndarray:
    steps = np.frombuffer(zlib.decompress(packed), dtype="<i2")
    return np.concatenate(([0], np.cumsum(steps, dtype=np.int32))).astype(np.int32)


def _counter(vocabulary: str) -> PrefixCounter:
    return worker_state(f"prefix_counter_{zlib.crc32(vocabulary.encode())}", lambda: PrefixCounter(vocabulary))


def _counts(vocabulary: str, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(vocabulary)
        for batch in batches:
            totals, chars, held = [], [], []
            for text in batch.column("text"):
                text = text.as_py()
                at, tokens = counter.longest(text, limit)
                totals.append(tokens if at == len(text) else counter.total(text))
                chars.append(at)
                held.append(tokens)
            columns = [batch.column("doc_id"), batch.column("n_bytes"), *(pa.array(c, pa.int64()) for c in (totals, chars, held))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_tokens", "kept_chars", "kept_tokens"])

    return run


def _tables(vocabulary: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(vocabulary)
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                counts = counter.prefixes(row.column("text")[0].as_py())
                columns = [row.column("doc_id"), row.column("n_bytes"), pa.array([int(counts[-1])], pa.int64()), pa.array([pack(counts)], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_tokens", "counts"])

    return run


def _rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    clean = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), clean.alias("text"), F.octet_length(utf8(text)).cast("bigint").alias("n_bytes"))


def _read_vocabulary(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def count_tokens(docs: DataFrame, vocabulary_path: str, limit: int = LIMIT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit, kept_chars, kept_tokens)`` for every row.

    The last two tell the longest prefix of at most ``limit`` tokens. ``vocabulary_path`` is a
    file of the driver; its content, a few megabytes whatever the corpus, travels with the tasks.
    """
    configure(docs.sparkSession)
    schema = "doc_id bigint, n_bytes bigint, n_tokens bigint, kept_chars bigint, kept_tokens bigint"
    found = _rows(docs, doc_id, text).mapInArrow(_counts(_read_vocabulary(vocabulary_path), limit), schema)
    return found.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "kept_chars", "kept_tokens")


def prefix_tables(docs: DataFrame, vocabulary_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, counts)``: the packed counts of all prefixes of every row's text."""
    configure(docs.sparkSession)
    schema = "doc_id bigint, n_bytes bigint, n_tokens bigint, counts binary"
    return _rows(docs, doc_id, text).mapInArrow(_tables(_read_vocabulary(vocabulary_path)), schema)


def truncate(tables: DataFrame, budgets: list[int]) -> DataFrame:
    """``(doc_id, budget, kept_chars, kept_tokens)`` for every stored table and budget."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, packed in zip(batch.column("doc_id").to_pylist(), batch.column("counts")):
                counts = unpack(packed.as_py())
                out += [(doc, budget, *longest_prefix(counts, budget)) for budget in budgets]
            columns = [pa.array(c, pa.int64()) for c in (zip(*out) if out else ([], [], [], []))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "budget", "kept_chars", "kept_tokens"])

    if min(budgets, default=0) < 0:
        raise ValueError("a budget is not negative")
    return tables.select("doc_id", "counts").mapInArrow(run, "doc_id bigint, budget bigint, kept_chars bigint, kept_tokens bigint")


def span_tokens(tables: DataFrame, spans: DataFrame) -> DataFrame:
    """``spans(doc_id, chars)`` with ``tokens``: what the first ``chars`` code points of a document cost.

    Positions beyond the text count the whole text, negative ones nothing; documents without a table are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chars = batch.column("chars").to_pylist()
            tokens = []
            for at, packed in zip(chars, batch.column("counts")):
                counts = unpack(packed.as_py())
                tokens.append(None if at is None else int(counts[min(max(at, 0), len(counts) - 1)]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("chars"), pa.array(tokens, pa.int64())], ["doc_id", "chars", "tokens"])

    asked = spans.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("chars").cast("bigint").alias("chars"))
    return asked.join(tables.select("doc_id", "counts"), "doc_id").mapInArrow(run, "doc_id bigint, chars bigint, tokens bigint")
