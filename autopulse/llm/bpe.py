"""Byte-pair encoding by backtracking over longest matches, and decoding through an offset table.

A word is encoded without running its merges.  An Aho-Corasick automaton over the vocabulary finds
the longest token at each place of the word; a token is taken if the merge order would really leave
it next to the token before it, else the next shorter one is tried, and where none fits the last
token is given up and its place marked.  Each place is given up once at most, so a word takes linear
time however long it is.  Whether two tokens may stand side by side follows from undoing their
merges in reverse order until a merge across the seam would have come first; the answers are kept in
a table of pairs.  Tokens that the merges never leave alone are not in the automaton.

White space never lies inside a word, so texts are cut at ASCII white space, a batch's distinct
pieces are encoded once, and dictionary indices put the documents' ids together.  All new words of a
batch run through the automaton as one string, and their neighbours are checked together; only
words in which some longest match does not fit go through the backtracking loop.  Pieces beyond the
Latin blocks are normalised and cut into words by the tokenizer file's own normaliser and splitter;
the merges are always ours.  Special tokens are found in the raw text, as the tokenizer file does.

Decoding gathers byte ranges: the vocabulary is one buffer, and each id has its start and size there.

Ids are little-endian unsigned 32-bit integers in a binary column, the form training shards use.

Defined cases: a null or empty text, or one of white space only, has no ids and decodes to an empty
text; very long texts and very long words are encoded whole; repeated rows get the same answer; ids
outside the vocabulary decode to nothing; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from autopulse.llm.common import map_batches, ranges, slices

SLICE_BYTES = 4 << 20
CACHED_WORDS = 1 << 19
CACHED_PAIRS = 1 << 20
FINAL = 0x1000  # a word's last symbol is moved up by this much: no other symbol of the vocabulary lies there
GAP = "\uffff"  # stands between words in one long string: no symbol of a vocabulary
#: Below this code point the file's normaliser only lower-cases; one letter there becomes two characters.
PLAIN_LIMIT = "ƀ"
LOWERS_TO_TWO = "İ"


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = (b for b in range(256) if b not in set(plain))
    moved = {b: 0x100 + i for i, b in enumerate(rest)}
    return [chr(moved.get(b, b)) for b in range(256)]


class Merges:
    """The vocabulary numbered in merge order: single symbols first, then each merge's product."""

    def __init__(self, spec: dict) -> None:
        model = spec["model"]
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges")
               if model.get(k)]
        if model["type"] != "BPE" or odd or spec.get("decoder") or spec.get("post_processor"):
            raise ValueError(f"this encoder has no form for {odd or 'this kind of tokenizer file'}")
        self.suffix = model.get("end_of_word_suffix") or ""
        vocab = model["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        products = {a + b for a, b in merges}
        self.names = [t for t in sorted(vocab, key=vocab.get) if t not in products]
        self.base = len(self.names)
        self.names += [a + b for a, b in merges]
        if len(set(self.names)) < len(self.names):
            raise ValueError("two merges make the same token")
        number = {name: i for i, name in enumerate(self.names)}
        self.ids = np.array([vocab[name] for name in self.names], dtype="<u4")
        self.head = [-1] * self.base + [number[a] for a, _ in merges]
        self.tail = [-1] * self.base + [number[b] for _, b in merges]
        self.pairs = {(number[a], number[b]): self.base + i for i, (a, b) in enumerate(merges)}
        self.table: dict[int, bool] = {}
        self.symbols = [self.spell(name) for name in self.names]
        self.size = [len(s) for s in self.symbols]

    def spell(self, name: str) -> str:
        """A token's symbols, one character each."""
        if self.suffix and name.endswith(self.suffix) and len(name) > len(self.suffix):
            name = name[: -len(self.suffix)]
            return name[:-1] + chr(ord(name[-1]) + FINAL)
        return name

    def apart(self, left: int, right: int, limit: int) -> bool:
        """Whether no merge across the seam of two tokens comes before merge ``limit`` or their own."""
        while True:
            across = self.pairs.get((left, right))
            if across is not None and across < limit:
                return False
            if max(left, right) < self.base:
                return True
            if left > right:  # the later merge is undone first; of equal ones the right, as merges go from the left
                limit, left = left, self.tail[left]
            else:
                limit, right = right + 1, self.head[right]

    def compatible(self, left: int, right: int) -> bool:
        """Whether the merges leave ``right`` next to ``left``, from the table of pairs seen before."""
        key = left << 32 | right
        known = self.table.get(key)
        if known is None:
            if len(self.table) >= CACHED_PAIRS:
                self.table.clear()
            known = self.table[key] = self.apart(left, right, len(self.names))
        return known


class Encoder:
    """Words to numbers of :class:`Merges` by longest matches and backtracking."""

    def __init__(self, merges: Merges) -> None:
        import ahocorasick

        self.merges = merges
        alone = [i < merges.base for i in range(len(merges.names))]
        for i in range(merges.base, len(alone)):
            a, b = merges.head[i], merges.tail[i]
            alone[i] = alone[a] and alone[b] and merges.apart(a, b, i)
        self.number = {merges.symbols[i]: i for i, ok in enumerate(alone) if ok}
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        self.shorter = [-1] * len(alone)  # the longest token that is a proper prefix of a token
        for s, i in self.number.items():
            self.automaton.add_word(s, i)
            self.shorter[i] = next((self.number[s[:k]] for k in range(len(s) - 1, 0, -1) if s[:k] in self.number), -1)
        self.automaton.make_automaton()
        self.size = merges.size
        self.sizes = np.array(merges.size, np.int64)
        self.id_bytes = [int(i).to_bytes(4, "little") for i in merges.ids]

    def encode(self, word: str) -> list[int]:
        """One word, by backtracking where a longest match does not fit."""
        size, shorter, table, compatible = self.size, self.shorter, self.merges.table, self.merges.compatible
        longest = [-1] * len(word)
        for end, i in self.automaton.iter(word):
            longest[end + 1 - size[i]] = i  # matches come by their ends, so the longest is the last one
        out: list[int] = []
        given_up = bytearray(len(word) + 1)
        at, token, last = 0, longest[0], -1
        while at < len(word):
            while token >= 0:
                if not given_up[at + size[token]]:
                    if last < 0:
                        break
                    fits = table.get(last << 32 | token)
                    if compatible(last, token) if fits is None else fits:
                        break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                at += size[token]
                last = token
                token = longest[at] if at < len(word) else -1
            else:
                if not out:
                    raise ValueError(f"a symbol of {word!r} is not in the vocabulary")
                given_up[at] = 1
                token = out.pop()
                at -= size[token]
                last = out[-1] if out else -1
        return out

    def encode_all(self, words: list[str]) -> list[bytes]:
        """The ids of all words: the longest matches of each where all neighbours fit, else by backtracking."""
        if not words:
            return []
        text = GAP.join(words) + GAP
        found = np.fromiter(chain.from_iterable(self.automaton.iter_long(text)), np.int64).reshape(-1, 2)
        ends, tokens = found[:, 0] + 1, found[:, 1]
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        word_ends = np.cumsum(sizes + 1) - 1
        of = np.searchsorted(word_ends, ends)
        bad = np.bincount(of, weights=self.sizes[tokens], minlength=len(words)) != sizes
        together = np.flatnonzero(of[1:] == of[:-1])
        pairs, places = np.unique(tokens[together] << 32 | tokens[together + 1], return_inverse=True)
        fits = np.fromiter((self.merges.compatible(p >> 32, p & 0xFFFFFFFF) for p in pairs.tolist()), bool, len(pairs))
        bad[of[together[~fits[places]]]] = True
        first = (4 * np.searchsorted(of, np.arange(len(words) + 1))).tolist()
        matched = self.merges.ids[tokens].tobytes()
        out = [matched[x:y] for x, y in zip(first, first[1:])]
        for i in np.flatnonzero(bad).tolist():
            out[i] = b"".join([self.id_bytes[t] for t in self.encode(words[i])])
        return out


class Tokenizer:
    """A tokenizer file: special tokens, normaliser and splitter, merges, and the decoder's tables."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer as File

        with open(path, encoding="utf-8") as lines:
            spec = json.load(lines)
        self.merges = Merges(spec)
        self.encoder = Encoder(self.merges)
        self.file = File.from_file(path)
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        if any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec.get("added_tokens", [])):
            raise ValueError("special tokens must be plain strings of the raw text")
        names = sorted(self.special, key=len, reverse=True)
        self.special_cut = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        self.byte_names = str.maketrans({chr(b): c for b, c in enumerate(byte_symbols())})
        # ids of words seen before; a special token has a key that no word can have
        self.special_ids = {GAP + name: int(i).to_bytes(4, "little") for name, i in self.special.items()}
        self.words = dict(self.special_ids)
        self.plain = self._plain_pattern()
        self._offset_table()

    def _plain_pattern(self) -> re.Pattern | None:
        """A pattern that cuts lower-cased Latin pieces as the file's own normaliser and splitter do; None if they differ."""
        known = [chr(c) for c in range(ord(PLAIN_LIMIT)) if chr(c) not in LOWERS_TO_TWO]
        kinds = {kind: re.escape("".join(c for c in known if unicodedata.category(c)[0] == kind)) for kind in "LN"}
        blank = "".join(c for c in known if c.isspace() and c not in "\x1c\x1d\x1e\x1f")
        # fixed: the contractions of the file's pattern
        pattern = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{kinds['L']}]+|[{kinds['N']}]|[^{kinds['L']}{kinds['N']}{re.escape(blank)}]+")
        probe = "".join(f"a{c}1{c}{c}!{c} " for c in known) + "'Sa'LLb'vec''d1'rex12'T3'Mm'"
        own = [self._spell(m) for m in pattern.findall(probe.lower())]
        return pattern if own == self._split_by_file(probe) else None

    def _spell(self, word: str) -> str:
        """A word's bytes as the vocabulary's symbols."""
        return word if word.isascii() and word.isprintable() else word.encode().decode("latin-1").translate(self.byte_names)

    def _split_by_file(self, piece: str) -> list[str]:
        if self.file.normalizer is not None:
            piece = self.file.normalizer.normalize_str(piece)
        return [word for word, _ in self.file.pre_tokenizer.pre_tokenize_str(piece)]

    def split(self, piece: str) -> list[str]:
        """The words of a piece of text, spelled in symbols."""
        if self.plain is None or not (piece.isascii() or max(piece) < PLAIN_LIMIT and LOWERS_TO_TWO not in piece):
            return self._split_by_file(piece)
        piece = piece.lower()
        if piece.isalpha():
            return [self._spell(piece)]
        return [self._spell(m) for m in self.plain.findall(piece)]

    def parts(self, piece: str) -> list[str]:
        """Words and special tokens of a piece of text without ASCII white space, as keys of ``words``."""
        if not self.special or "<" not in piece:
            return self.split(piece) if piece else []
        out: list[str] = []
        for part in self.special_cut.split(piece):
            if part in self.special:
                out.append(GAP + part)
            elif part:
                out += self.split(part)
        return out

    def pieces_ids(self, pieces: list[str]) -> list[bytes]:
        cut = [self.parts(p) for p in pieces]
        seen = set(chain.from_iterable(cut))
        missing = list(seen.difference(self.words))
        if missing and len(self.words) + len(missing) > CACHED_WORDS:
            self.words = dict(self.special_ids)
            missing = list(seen.difference(self.words))
        spelled = [w[:-1] + chr(ord(w[-1]) + FINAL) for w in missing] if self.merges.suffix else missing
        self.words.update(zip(missing, self.encoder.encode_all(spelled)))
        known = self.words
        return [known[p[0]] if len(p) == 1 else b"".join([known[w] for w in p]) for p in cut]

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and the n + 1 places where each text's ids begin."""
        pieces = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        coded = pc.list_flatten(pieces).dictionary_encode()
        ids = self.pieces_ids(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat = np.frombuffer(b"".join(ids), "<u4")
        starts = np.cumsum(sizes) - sizes
        codes = coded.indices.to_numpy()
        out = flat[ranges(starts[codes], sizes[codes])]
        ends = np.concatenate(([0], np.cumsum(sizes[codes])))
        return out, ends[pieces.offsets.to_numpy() - pieces.offsets[0].as_py()]

    def _offset_table(self) -> None:
        """All names in one buffer, each with the blank that follows it in a decoded text."""
        names = dict(zip(self.merges.ids.tolist(), self.merges.names)) | {i: s for s, i in self.special.items()}
        spelled = [(names[i] + " ").encode() if i in names else b"" for i in range(max(names) + 1)]
        self.letters = np.frombuffer(b"".join(spelled), np.uint8)
        self.sizes = np.array([len(s) for s in spelled], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def decode(self, ids: np.ndarray) -> bytes:
        ids = ids[ids < len(self.sizes)].astype(np.int64)
        return self.letters[ranges(self.starts[ids], self.sizes[ids])].tobytes()[:-1]


@lru_cache(maxsize=2)
def tokenizer(path: str) -> Tokenizer:
    return Tokenizer(path)


def encode(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids`` of every row; ``path`` names a tokenizer file that every node has."""
    path = path or default_path()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, limit=SLICE_BYTES):
                ids, at = tokenizer(path).encode_column(part.column("text"))
                coded = [ids[a:b].tobytes() for a, b in zip(at, at[1:])]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(np.diff(at)), pa.array(coded, pa.binary())],
                                                 names=["doc_id", "n_tokens", "ids"])

    return map_batches(rows, run, f"doc_id {kind}, n_tokens long, ids binary")


def decode(rows: DataFrame, path: str | None = None, ids_col: str = "ids") -> DataFrame:
    """All columns of ``rows`` and ``decoded``, the text that ``ids_col`` (as made by ``encode``) stands for."""
    path = path or default_path()
    kept = rows.drop("decoded")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema) + ", decoded string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                texts = [tokenizer(path).decode(np.frombuffer(x.as_buffer() if x.is_valid else b"", "<u4")).decode()
                         for x in part.column(ids_col)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())],
                                                 names=[*part.schema.names, "decoded"])

    return map_batches(kept, run, schema)
