"""Encoding with a piece vocabulary by backtracking, and decoding.

The vocabulary merges adjacent pieces whenever their concatenation is a piece, best score
first. Instead of merging, the encoder walks over the text once: an Aho-Corasick automaton
gives the longest piece that ends at each place, and from it, through suffix links, all
shorter ones. A piece may follow the piece before it only if re-merging the two would
leave the border between them alone, which is looked up by undoing their merges. Where no
piece fits, the walk steps back; a bitfield holds the places from which no encoding goes
on, so that no place fails twice.

A piece with a space mark inside never follows another character in this kind of
vocabulary, so a text falls apart before each run of space marks, and equal parts have
equal ids. Workers remember the parts they have met.

Defined results: a null text is encoded as empty; the empty text has no ids; characters
outside the vocabulary become their bytes; equal texts get equal ids.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from headway.llm import common

SPACE = "▁"
#: Parts of texts whose ids a worker remembers.
REMEMBERED = 200_000
#: Longer parts are encoded each time.
LONGEST_REMEMBERED = 64


class Pieces:
    """A vocabulary with its automaton and the merges that make each piece."""

    def __init__(self, path: str) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(n)]
        self.byte_id: dict[int, int] = {}
        self.byte_of: dict[int, int] = {}
        special = set()
        for i in range(n):
            if model.is_byte(i):
                value = int(self.pieces[i][3:-1], 16)
                self.byte_id[value], self.byte_of[i] = i, value
            if model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                special.add(i)
        self.plain = [i for i in range(n) if i not in special]
        self.control = {i for i in range(n) if model.is_control(i)}
        self.unknown_id = model.unk_id()
        self.id_of = {self.pieces[i]: i for i in self.plain}
        self.rank = {i: model.get_score(i) for i in self.plain}
        if any(SPACE in p.lstrip(SPACE) for p in self.id_of):
            raise ValueError("a piece holds a space mark behind another character")
        self._find_merges()
        self._build_automaton()
        self.surface = self._surfaces(model)

    def _surfaces(self, model) -> list[str]:
        out = [p.replace(SPACE, " ") for p in self.pieces]
        for i in self.control:
            out[i] = ""
        if self.unknown_id >= 0:
            out[self.unknown_id] = model.decode([self.unknown_id])
        return out

    def merge_plainly(self, text: str) -> list[int]:
        """Ids by merging the best pair, leftmost first, until none is left."""
        parts = [self.id_of[c] for c in text]
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                joined = self.id_of.get(self.pieces[parts[i]] + self.pieces[parts[i + 1]])
                if joined is not None and (best is None or self.rank[joined] > self.rank[best]):
                    best, at = joined, i
            if best is None:
                break
            parts[at : at + 2] = [best]
        return parts

    def _find_merges(self) -> None:
        """For each piece, the last merge that makes it; pieces that no merging makes are left out."""
        self.halves: dict[int, tuple[int, int]] = {}
        self.reachable: set[int] = set()
        for i in sorted(self.plain, key=lambda i: len(self.pieces[i])):
            text = self.pieces[i]
            if len(text) == 1:
                self.reachable.add(i)
                continue
            if any(c not in self.id_of for c in text):
                continue
            halves = self._last_merge(text, i)
            if halves is not None:
                self.halves[i] = halves
                self.reachable.add(i)

    def _last_merge(self, text: str, piece: int) -> tuple[int, int] | None:
        parts = [self.id_of[c] for c in text]
        while len(parts) > 2:
            best, at = None, -1
            for i in range(len(parts) - 1):
                joined = self.id_of.get(self.pieces[parts[i]] + self.pieces[parts[i + 1]])
                if joined is not None and (best is None or self.rank[joined] > self.rank[best]):
                    best, at = joined, i
            if best is None:
                return None
            parts[at : at + 2] = [best]
        return (parts[0], parts[1]) if len(parts) == 2 else None

    def _build_automaton(self) -> None:
        self.automaton = ahocorasick.Automaton()
        for i in self.reachable:
            self.automaton.add_word(self.pieces[i], (len(self.pieces[i]) - 1, i))
        self.automaton.make_automaton()
        self.sizes = [len(p) for p in self.pieces]
        # the next shorter reachable piece that starts like a piece
        self.shorter: dict[int, int] = {}
        for i in self.reachable:
            text = self.pieces[i]
            for n in range(len(text) - 1, 0, -1):
                j = self.id_of.get(text[:n])
                if j is not None and j in self.reachable:
                    self.shorter[i] = j
                    break

    @lru_cache(maxsize=1 << 18)  # noqa: B019 - one vocabulary lives as long as its worker
    def fit_together(self, left: int, right: int) -> bool:
        """Whether merging the text of two pieces anew leaves the border between them."""
        pieces, id_of, rank, halves = self.pieces, self.id_of, self.rank, self.halves
        limit = -float("inf")  # every merge across the border must come too late, below this score
        last_side = None
        while True:
            joined = id_of.get(pieces[left] + pieces[right])
            if joined is not None:
                score = rank[joined]
                # the later of the two pieces is undone in each step, and with it the limit moves
                if score > limit or (score == limit and last_side == "right"):
                    return False
            left_made = rank[left] if left in halves else None
            right_made = rank[right] if right in halves else None
            if left_made is None and right_made is None:
                return True
            # undo the merge that was done last: the lower score, or of equal ones the right
            if right_made is None or (left_made is not None and left_made < right_made):
                limit, last_side = left_made, "left"
                left = halves[left][1]
            else:
                limit, last_side = right_made, "right"
                right = halves[right][0]

    def longest_from(self, text: str) -> list[int]:
        """The longest piece that starts at each place of a text of known characters."""
        longest = [0] * len(text)
        # matches come by their ends, so of those that start at a place the longest comes last
        for end, (reach, piece) in self.automaton.iter(text):
            longest[end - reach] = piece
        return longest

    def encode_known(self, text: str) -> list[int]:
        """Ids of a text whose characters are all pieces."""
        n = len(text)
        whole = self.id_of.get(text)
        if whole is not None and (n == 1 or whole in self.reachable):
            return [whole]
        longest = self.longest_from(text)
        failed = bytearray((n >> 3) + 1)  # a bit for each place from which encoding is known to fail
        sizes, fit_together = self.sizes, self.fit_together
        ids: list[int] = []
        place, piece, before = 0, longest[0], -1
        while place < n:
            end = place + sizes[piece]
            if not failed[end >> 3] >> (end & 7) & 1 and (before < 0 or fit_together(before, piece)):
                ids.append(piece)
                place, before = end, piece
                if place < n:
                    piece = longest[place]
                continue
            while True:
                shorter = self.shorter.get(piece)
                if shorter is not None:
                    piece = shorter
                    break
                failed[place >> 3] |= 1 << (place & 7)
                if not ids:
                    raise ValueError(f"no encoding of {text!r}")
                piece = ids.pop()
                place -= sizes[piece]
                before = ids[-1] if ids else -1
        return ids

    def encode_part(self, text: str) -> list[int]:
        """Ids of a part, with the bytes of its unknown characters."""
        if all(map(self.id_of.__contains__, text)):
            return self.encode_known(text)
        ids: list[int] = []
        at = 0
        for i, c in enumerate(text):
            if c not in self.id_of:
                if i > at:
                    ids += self.encode_known(text[at:i])
                ids += [self.byte_id[b] for b in c.encode("utf-8")]
                at = i + 1
        if at < len(text):
            ids += self.encode_known(text[at:])
        return ids

    def decode(self, ids: Sequence[int], first: bool = True) -> str:
        """The text of ids: runs of byte pieces are read as UTF-8.

        The first space mark goes, unless the ids continue others (``first`` is false).
        """
        surface = self.surface
        if not first and self.byte_of.keys().isdisjoint(ids):
            return "".join([surface[i] for i in ids])
        out: list[str] = []
        waiting = bytearray()
        for i in ids:
            value = self.byte_of.get(i)
            if value is not None:
                waiting.append(value)
                continue
            if waiting:
                out.append(_bytes_text(bytes(waiting)))
                waiting.clear()
                first = False
            piece = surface[i]
            if first and i not in self.control:
                piece = piece[1:] if piece.startswith(" ") and i != self.unknown_id else piece
                first = False
            out.append(piece)
        if waiting:
            out.append(_bytes_text(bytes(waiting)))
        return "".join(out)


def _bytes_text(data: bytes) -> str:
    """UTF-8, with one replacement character for each byte that is no part of a character."""
    out: list[str] = []
    at = 0
    while at < len(data):
        for n in (1, 2, 3, 4):
            try:
                out.append(data[at : at + n].decode("utf-8"))
            except UnicodeDecodeError:
                continue
            at += n
            break
        else:
            out.append("�")
            at += 1
    return "".join(out)


#: A run of space marks and what follows up to the next.
_PART = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


class Encoder:
    """A vocabulary with what is known of the parts met lately, in two generations.

    Of a part it keeps the number of ids, the ids as text and the decoded text. A part begins
    with a space mark, which is a piece, so no run of byte pieces goes from one part into
    the next, and the decoded parts of a text are its decoding, but for the first mark.
    """

    def __init__(self, path: str) -> None:
        self.vocabulary = Pieces(path)
        self.known: dict[str, tuple[int, str, str]] = {}
        self.older: dict[str, tuple[int, str, str]] = {}

    def _part(self, part: str) -> tuple[int, str, str]:
        found = self.older.get(part)
        if found is None:
            ids = self.vocabulary.encode_part(part)
            found = len(ids), ",".join(map(str, ids)), self.vocabulary.decode(ids, first=False)
            if len(part) > LONGEST_REMEMBERED:
                return found
        if len(self.known) >= REMEMBERED:
            self.older, self.known = self.known, {}
        self.known[part] = found
        return found

    def parts(self, text: str) -> list[tuple[int, str, str]]:
        """Number of ids, ids and decoded text of each part of a text."""
        if not text:
            return []
        get, make = self.known.get, self._part
        out = []
        for part in _PART.findall(SPACE + text.replace(" ", SPACE)):
            found = get(part)
            if found is None:
                found = make(part)
                get = self.known.get
            out.append(found)
        return out

    def encode(self, text: str) -> list[int]:
        return [int(i) for _, ids, _ in self.parts(text) for i in ids.split(",")]


def decoded(parts: list[tuple[int, str, str]]) -> str:
    """The decoding of all ids of a text."""
    return "".join([d for _, _, d in parts]).removeprefix(" ")


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder, kept from task to task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """One row per document: doc_id, n_tokens, and hashes of its ids and of the decoded text."""
    common.prepare(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for batch in batches:
            sizes, codes, texts = [], [], []
            for text in common.plain_texts(batch.column("text")):
                parts = coder.parts(text)
                sizes.append(sum([n for n, _, _ in parts]))
                codes.append(hashlib.sha256(",".join([c for _, c, _ in parts]).encode()).hexdigest())
                texts.append(hashlib.sha256(decoded(parts).encode("utf-8")).hexdigest())
            hashes = pa.array(codes, pa.string()), pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(sizes, pa.int64()), *hashes],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select("doc_id", "text").mapInArrow(run, schema)
