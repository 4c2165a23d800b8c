"""Tokens of whole texts, by looking up the pieces between white space.

No tokenizer used here merges across the cuts made here, so the ids of a text
are those of its pieces one after another. A worker keeps the ids of pieces it
has met, up to a limit.
"""

from __future__ import annotations

import re
import struct
import unicodedata
from collections.abc import Callable
from functools import lru_cache

import tiktoken
from tokenizers import Tokenizer

from tidemark.llm.shared import worker_tables

# The characters with the Unicode property White_Space.
WHITE_SPACE = "\t\n\v\f\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

# A word with the blank before it; white space up to the last before a word; the rest.
SPACED_PIECES = re.compile(f" ?[^{WHITE_SPACE}]+|[{WHITE_SPACE}]+(?![^{WHITE_SPACE}])|[{WHITE_SPACE}]+")

# Other than the blank and the line feed.
RARE_SPACE = [*"\t\v\f\r\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000", *map(chr, range(0x2000, 0x200B))]
ASCII_RARE_SPACE = [c for c in RARE_SPACE if c.isascii()]
# Marks that are a pre-token of their own between a letter and white space.
MARKS = frozenset(".,;:!?")

PIECES_KEPT = 250_000  # of the latest, and as many from before
# Where a worker has one table only.
WORDS_KEPT = 600_000
LONGEST_KEPT = 100
# Packers of so many ids as little-endian unsigned 32-bit integers.
PACKERS = [struct.Struct(f"<{n}I").pack for n in range(32)]


def is_plain_word(piece: str) -> bool:
    """Whether a piece is letters that all versions of Unicode know as such."""
    return piece.isalpha() and (piece.isascii() or max(piece) < "\u0530")


class PieceIds(dict):
    """Ids of a piece as little-endian unsigned 32-bit integers, encoded when first met.

    A word with one mark behind it is taken apart, so that the word is met less
    often for the first time. The pieces used since the table was last full stay
    when it is full again.
    """

    def __init__(
        self,
        encode: Callable[[str], list[int]],
        mark: Callable[[str], bytes] | None = None,
        is_word: Callable[[str], bool] | None = None,
        kept: int | None = None,
    ):
        super().__init__()
        self.kept = kept or PIECES_KEPT
        self.encode, self.mark, self.is_word = encode, mark or self.__getitem__, is_word or is_plain_word
        self.earlier: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        packed = self.earlier.get(piece)
        if packed is None:
            if piece[-1:] in MARKS and self.is_word(piece[:-1]):
                packed = self[piece[:-1]] + self.mark(piece[-1])
            else:
                ids = self.encode(piece)
                n = len(ids)
                packed = PACKERS[n](*ids) if n < len(PACKERS) else struct.pack(f"<{n}I", *ids)
            if len(piece) > LONGEST_KEPT:
                return packed
        if len(self) >= self.kept:
            self.earlier = dict(self)
            self.clear()
        self[piece] = packed
        return packed


def spaced_ids(encode: Callable[[str], list[int]]) -> Callable[[str], bytes]:
    """Coder of texts for a vocabulary in which white space counts.

    ``encode`` gives the ids of any string. Most texts have single blanks and line
    feeds only: they are cut at these, and a table for the words after a blank
    keeps them without it. Other texts are cut by a pattern.
    """
    own = PieceIds(encode)
    pieces = own.__getitem__

    def after_space(word: str) -> list[int]:
        if word[0] == "\n":
            return memoryview(pieces("\n") + pieces(word[1:])).cast("I").tolist()
        return encode(" " + word)

    after = PieceIds(after_space, mark=pieces).__getitem__

    def code(text: str) -> bytes:
        rare = ASCII_RARE_SPACE if text.isascii() else RARE_SPACE
        if (
            not text
            or text[0] in " \n"
            or text[-1] in " \n"
            or "  " in text
            or "\n\n" in text
            or " \n" in text
            or "\n " in text
            or any(c in text for c in rare)
        ):
            return b"".join(map(pieces, SPACED_PIECES.findall(text)))
        first, *words = text.replace("\n", " \n").split(" ")
        return pieces(first) + b"".join(map(after, words))

    return code


def byte_alphabet() -> str:
    """The printable character that stands for each byte in byte-level vocabularies.

    Printable Latin-1 characters stand for themselves, the other bytes in
    ascending order for the characters from U+0100.
    """
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = (b for b in range(256) if b not in own)
    table = {b: chr(b) for b in own} | {b: chr(0x100 + i) for i, b in enumerate(others)}
    return "".join(table[b] for b in range(256))


def _split_coder(tokenizer: Tokenizer) -> Callable[[str], list[int]]:
    """Ids of a piece in normal form: split and merge by the library's own parts."""
    merge, split = tokenizer.model.tokenize, tokenizer.pre_tokenizer
    to_alphabet = dict(enumerate(byte_alphabet()))

    def encode(piece: str) -> list[int]:
        word = piece[1:] if piece[:1] == " " else piece
        if is_plain_word(word):  # one pre-token
            if not piece.isascii() or piece is not word:
                piece = piece.encode().decode("latin-1").translate(to_alphabet)
            return [t.id for t in merge(piece)]
        return [t.id for part, _ in split.pre_tokenize_str(piece) for t in merge(part)]

    return encode


def _ranked_coder(tokenizer: Tokenizer) -> Callable[[str], list[int]]:
    """As ``_split_coder``, merging by rank, for a vocabulary whose ids are in the order of its merges.

    Merging the pair whose result has the lowest id is the same as following the
    list of merges if every entry is what its own text is merged to. Both are
    checked; a vocabulary of another kind is left to the library's merges.
    """
    by_merges = _split_coder(tokenizer)
    alphabet = byte_alphabet()
    to_byte = {ord(c): b for b, c in enumerate(alphabet)}
    special = set(tokenizer.get_added_tokens_decoder())
    entries = {e: i for e, i in tokenizer.get_vocab(with_added_tokens=True).items() if i not in special}
    single = [entries.get(c) for c in alphabet]
    merge = tokenizer.model.tokenize
    if (
        None in single
        or any(ord(c) not in to_byte for e in entries for c in e)
        or max(single) >= min((i for e, i in entries.items() if len(e) > 1), default=len(entries))
        or any([t.id for t in merge(e)] != [i] for e, i in entries.items())
    ):
        return by_merges
    ranks = {e.translate(to_byte).encode("latin-1"): i for e, i in entries.items()}
    by_rank = tiktoken.Encoding("ranked", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
    one_piece = by_rank.encode_ordinary

    def encode(piece: str) -> list[int]:
        if is_plain_word(piece[1:] if piece[:1] == " " else piece):  # one pre-token
            return one_piece(piece)
        return by_merges(piece)

    return encode


def _whole_coder(tokenizer: Tokenizer) -> Callable[[str], list[int]]:
    """Ids of any string, by the library as a whole."""
    tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
    return lambda piece: tokenizer.encode(piece, add_special_tokens=False).ids


def spaced_coder(vocabulary: bytes) -> Callable[[str], bytes]:
    """Ids of a text by a byte-level vocabulary (tokenizers JSON) that keeps white space."""
    made = worker_tables(__name__)
    if vocabulary not in made:
        made[vocabulary] = _spaced_coder(vocabulary)
    return made[vocabulary]


def _spaced_coder(vocabulary: bytes) -> Callable[[str], bytes]:
    return spaced_ids(_ranked_coder(Tokenizer.from_str(vocabulary.decode())))


@lru_cache(maxsize=4)
def word_coder(vocabulary: bytes) -> Callable[[str], bytes]:
    """Ids of a text by a vocabulary (tokenizers JSON) that drops white space and case.

    Nearly all texts are in normal form NFC, before and after lower case: these are
    lowered as a whole, so that their words need no normalisation one by one and
    are in the table once, however written.
    """
    tokenizer = Tokenizer.from_str(vocabulary.decode())
    lowered = PieceIds(_split_coder(tokenizer), kept=WORDS_KEPT).__getitem__
    others = PieceIds(_whole_coder(tokenizer), is_word=lambda piece: False).__getitem__
    normal = tokenizer.normalizer.normalize_str
    # Lowered by what stands around them, or otherwise by the library.
    odd = {"Σ", "İ"} | {c for c in map(chr, range(0x110000)) if c != c.lower() != normal(c)}
    common = re.compile("[\0-\u052f]*").fullmatch
    odd_and_common = [c for c in map(chr, range(0x530)) if c in odd or unicodedata.category(c) == "Cn"]

    def has_odd_capital(text: str) -> bool:
        """Also true of characters that are not known here, as the library may know them."""
        if common(text):
            return any(c in text for c in odd_and_common)
        return any(c in odd or unicodedata.category(c) == "Cn" for c in set(text))

    # ASCII white space only: other white space is left to the library.
    cut = re.compile("[^\t\n\v\f\r ]+").findall

    def code(text: str) -> bytes:
        # split() also cuts at these, which are no white space here.
        words = str.split if not any(c in text for c in "\x1c\x1d\x1e\x1f") else cut
        if text.isascii():
            return b"".join(map(lowered, words(text.lower())))
        if not has_odd_capital(text):
            lower = text.lower()
            if unicodedata.is_normalized("NFC", text) and unicodedata.is_normalized("NFC", lower):
                return b"".join(map(lowered, words(lower)))
        return b"".join(map(others, words(text)))

    return code
