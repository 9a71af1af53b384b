"""BPE encoding and decoding as bounded-lookahead streaming transducers.

The merge list fixes how far a token boundary can depend on symbols to its right: if
two inputs agree on a prefix, each merge that acts differently on them moves the point
of agreement left by the length of its left operand, later merges only, and the right
operand of the next such merge must start with that left operand. The heaviest chain
of such merges (:func:`sufficient_lookahead`) bounds the total movement, so a token
that ends at least that many symbols before the end of the window read so far is
final. The encoder keeps two windows of symbols at most, emits final tokens and drops
them; decoding feeds token bytes through an incremental UTF-8 state machine.

Text is cut at white space (no pre-token spans it), normalised and split per piece; a
bounded cache holds the ids of frequent pieces.

Results for odd input: a null or empty text has no ids; special-token strings in a
text give their ids, as the library does without ``encode_special_tokens``.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import unicodedata
from array import array
from collections.abc import Callable, Iterator
from functools import cached_property

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from tessera.llm.common import kept, small_batches

BITS = 20
MASK = (1 << BITS) - 1
NONE = 1 << 62
#: Bytes of a cache generation, and what an entry takes besides its string and its ids.
PIECE_CACHE_BYTES, WORD_CACHE_BYTES, ENTRY_BYTES = 72 << 20, 12 << 20, 190
CACHED_CHARS = 64
SLICE_CHARS = 1 << 16
LATIN_END = "\u0250"
# Unicode White_Space; str.split() also cuts at U+001C..U+001F, which are not in it.
SPACE = regex.compile("[\t-\r \x85\xa0  -     　]+")
CONTROL = "\x1c\x1d\x1e\x1f"


def byte_alphabet() -> list[str]:
    """Printable stand-in of each byte in byte-level vocabularies: a byte that is a
    visible Latin-1 character stands for itself, the others follow from U+0100."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in visible]
    return [chr(b) if b in visible else chr(256 + hidden.index(b)) for b in range(256)]


def sufficient_lookahead(merges: list[tuple[str, str]]) -> int:
    """Largest total length of left operands over chains of ever later merges whose
    right operand starts with the previous left operand."""
    heaviest: dict[str, int] = {}
    most = 1
    for left, right in merges:
        before = max((heaviest.get(right[:i], 0) for i in range(1, len(right) + 1)), default=0)
        total = len(left) + before
        heaviest[left] = max(total, heaviest.get(left, 0))
        most = max(most, total)
    return most


class Recent:
    """Cache of the results of ``make`` for short strings: two generations of about
    ``size`` bytes each; a full one becomes the older, and the oldest goes."""

    def __init__(self, size: int, make: Callable[[str], bytes]):
        self.size, self.make, self.held = size, make, 0
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def of(self, key: str) -> bytes:
        value = self.new.get(key)
        if value is None:
            value = self.old.get(key)
            if value is None:
                value = self.make(key)
            if len(key) <= CACHED_CHARS:
                if self.held >= self.size:
                    self.new, self.old, self.held = {}, self.new, 0
                self.new[key] = value
                self.held += ENTRY_BYTES + len(key) + len(value)
        return value


class Encoder:
    """Streaming encoder for one tokenizer file (BPE with byte alphabet and word ends)."""

    def __init__(self, spec: dict, lookahead: int | None = None, source: str | None = None, cache_bytes: int = PIECE_CACHE_BYTES):
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.end = model.get("end_of_word_suffix") or ""
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        made = {}
        self.pairs: dict[int, int] = {}
        for rank, (a, b) in enumerate(merges):
            if max(made.get(a, -1), made.get(b, -1)) >= rank:
                raise ValueError("merge list is not in training order")
            made.setdefault(a + b, rank)
            self.pairs.setdefault(self.vocab[a] << BITS | self.vocab[b], rank << BITS | self.vocab[a + b])
        self.lookahead = lookahead or sufficient_lookahead(merges)
        alphabet = byte_alphabet()
        self.first = [self.vocab[c] for c in alphabet]
        self.last = [self.vocab[c + self.end] for c in alphabet]
        self.specials = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        self.special_re = regex.compile("|".join(map(regex.escape, self.specials))) if self.specials else None
        self.source = source or json.dumps(spec)
        self.back = {c: b for b, c in enumerate(alphabet)}
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(split["pattern"]["Regex"])
        self.by_word = Recent(min(WORD_CACHE_BYTES, cache_bytes), self._word)
        self.by_piece = Recent(cache_bytes, self._piece)

    @cached_property
    def library(self) -> Tokenizer:
        """The library's tokenizer (normaliser and splitter), made when a text needs it; its merges
        are left out."""
        spec = json.loads(self.source)
        spec["model"] |= {"vocab": {t: i for t, i in spec["model"]["vocab"].items() if len(t) < 2}, "merges": []}
        return Tokenizer.from_str(json.dumps(spec))

    def merge(self, symbols: list[int]) -> list[int]:
        """Apply the merge list to ``symbols``: lowest rank first, left to right."""
        get = self.pairs.get
        found = [get(a << BITS | b, NONE) for a, b in zip(symbols, symbols[1:])]
        last = len(found) - 1
        while last >= 0 and (best := min(found)) != NONE:
            i = found.index(best)
            symbols[i] = made = best & MASK
            del symbols[i + 1], found[i]
            if i:
                found[i - 1] = get(symbols[i - 1] << BITS | made, NONE)
            if i < last:
                found[i] = get(made << BITS | symbols[i + 1], NONE)
            last -= 1
        return symbols

    def transduce(self, word: bytes) -> Iterator[int]:
        """Ids of one pre-token; at most ``2 * lookahead`` symbols are held."""
        window, size = 2 * self.lookahead, len(word)
        buffer: list[int] = []
        for i, byte in enumerate(word):
            buffer.append(self.first[byte] if i < size - 1 else self.last[byte])
            if len(buffer) >= window and i < size - 1:
                taken = 0
                for token in self.merge(buffer[:]):
                    width = self.width(token)
                    if taken + width > len(buffer) - self.lookahead:
                        break
                    yield token
                    taken += width
                buffer = buffer[taken:]
        yield from self.merge(buffer)

    def width(self, token: int) -> int:
        """Symbols that ``token`` covers."""
        if not hasattr(self, "widths"):
            self.widths = {i: len(t.removesuffix(self.end)) if t != self.end else 1 for t, i in self.vocab.items()}
        return self.widths[token]

    def _word(self, word: str) -> bytes:
        raw = word.encode()
        if len(raw) < 2 * self.lookahead:
            symbols = [*map(self.first.__getitem__, raw)]
            symbols[-1] = self.last[raw[-1]]
            return array("I", self.merge(symbols)).tobytes()
        return array("I", self.transduce(raw)).tobytes()

    def split(self, piece: str) -> list[str]:
        """Normalised pre-tokens. Beyond Latin letters the character classes depend on
        the Unicode version, so the library's own normaliser and splitter decide."""
        if piece.isascii():
            if piece.isalpha():
                return [piece.lower()]
            if piece[-1:] in (",", ".") and piece[:-1].isalpha():
                return [piece[:-1].lower(), piece[-1]]
            return self.words.findall(piece.lower())
        if max(piece) < LATIN_END:
            piece = unicodedata.normalize("NFC", piece)
            return self.words.findall("".join(c.lower() for c in piece))
        parts = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(piece))
        return [bytes(map(self.back.__getitem__, p)).decode() for p, _ in parts]

    def _piece(self, piece: str) -> bytes:
        """Ids (unsigned 32-bit, native order) of a run without white space."""
        if self.special_re and "<" in piece:
            parts, at = [], 0
            for m in self.special_re.finditer(piece):
                parts += [*map(self.by_word.of, self.split(piece[at : m.start()]))]
                parts.append(array("I", [self.specials[m[0]]]).tobytes())
                at = m.end()
            parts += [*map(self.by_word.of, self.split(piece[at:]))]
            return b"".join(parts)
        words = self.split(piece)
        if words == [piece]:
            return self._word(piece)
        # an ASCII pre-token is a piece with the same ids, so both share one cache
        return b"".join([self.by_piece.of(w) if w.isascii() else self.by_word.of(w) for w in words])

    def encode(self, text: str | None) -> Iterator[bytes]:
        """Ids of a text, slice by slice (slices end at white space)."""
        at, size = 0, len(text or "")
        while at < size:
            get = self.by_piece.new.get
            to = min(at + SLICE_CHARS, size)
            if to < size:
                m = SPACE.search(text, to)
                to = m.start() if m else size
            part = text[at:to]
            pieces = part.split() if not any(c in part for c in CONTROL) else [p for p in SPACE.split(part) if p]
            out, i = [*map(get, pieces)], -1
            for _ in range(out.count(None)):
                i = out.index(None, i + 1)
                out[i] = self.by_piece.of(pieces[i])
            yield b"".join(out)
            at = to


class Decoder:
    """Incremental ids-to-text decoder. With no decoder in the tokenizer file the
    library joins token strings by a space; ``plain=True`` gives the bytes behind
    the byte alphabet instead, word ends as spaces."""

    def __init__(self, spec: dict, plain: bool = False):
        model = spec["model"]
        end = model.get("end_of_word_suffix") or ""
        strings = dict(model["vocab"]) | {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        if not plain and spec.get("decoder") is not None:
            raise ValueError("only tokenizer files without a decoder are joined; use plain=True")
        if plain:
            back = {c: b for b, c in enumerate(byte_alphabet())}

            def raw(t: str) -> bytes:
                cut, tail = (t[: -len(end)], b" ") if end and t.endswith(end) else (t, b"")
                return (bytes(back[c] for c in cut) if all(c in back for c in cut) else cut.encode()) + tail

        self.table = [b""] * (max(strings.values()) + 1)
        for t, i in strings.items():
            self.table[i] = raw(t) if plain else t.encode()
        self.glue = b"" if plain else b" "
        self.reset()

    def reset(self) -> None:
        self.state, self.begun = codecs.getincrementaldecoder("utf-8")("replace"), False

    def feed(self, ids: bytes) -> str:
        """Text that has become certain with these ids (unsigned 32-bit)."""
        if not ids:
            return ""
        joined = self.glue.join(map(self.table.__getitem__, array("I", ids)))
        if self.begun:
            joined = self.glue + joined
        self.begun = True
        return self.state.decode(joined)

    def finish(self) -> str:
        return self.state.decode(b"", final=True)


def loaded(text: str) -> tuple[dict, Encoder]:
    """The tokenizer file's content, and this worker's encoder of it."""
    return json.loads(text), encoder_of(text)


def encoder_of(text: str, cache_bytes: int = PIECE_CACHE_BYTES) -> Encoder:
    """One encoder of the tokenizer file per worker process; the file's parsed content is not kept."""
    key = f"{hashlib.sha256(text.encode()).hexdigest()} {cache_bytes}"
    return kept(key, lambda: Encoder(json.loads(text), source=text, cache_bytes=cache_bytes))


def read_spec(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``ids`` (array of long) of every whole text."""
    spec = docs.sparkSession.sparkContext.broadcast(read_spec(tokenizer_path))

    def run(batches):
        encoder = encoder_of(spec.value)
        for batch in batches:
            for i, text in zip(batch.column(0), batch.column(1)):
                ids = array("I", b"".join(encoder.encode(text.as_py())))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i.as_py()], batch.schema[0].type), pa.array([ids.tolist()], pa.list_(pa.int64()))],
                    names=[id_col, "ids"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).transform(small_batches).mapInArrow(run, f"`{id_col}` {kind}, ids array<bigint>")


def round_trip(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every whole text, decode the ids again, and return per row ``id_col``,
    ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``. Rows pass slice by slice; no
    row's ids or decoded text is held whole."""
    spec = docs.sparkSession.sparkContext.broadcast(read_spec(tokenizer_path))

    def run(batches):
        encoder, decoder = encoder_of(spec.value), Decoder(json.loads(spec.value))
        for batch in batches:
            out = []
            for text in batch.column(1):
                ids_hash, text_hash, n = hashlib.sha256(), hashlib.sha256(), 0
                decoder.reset()
                for ids in encoder.encode(text.as_py()):
                    n += len(ids) // 4
                    ids_hash.update(ids)
                    text_hash.update(decoder.feed(ids).encode())
                text_hash.update(decoder.finish().encode())
                out.append((n, ids_hash.hexdigest(), text_hash.hexdigest()))
            cols = list(zip(*out)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.string())],
                names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).transform(small_batches).mapInArrow(
        run, f"`{id_col}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )
