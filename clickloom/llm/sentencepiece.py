"""SentencePiece encoding and decoding: piece automaton and single-pass Viterbi."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from itertools import pairwise

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import batch

SPACE = "▁"
#: Kinds of pieces in a model file.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: What a character without a piece costs beyond the worst piece.
UNKNOWN_PENALTY = 10.0
#: Segments a worker remembers; the memory is emptied when it is full.
REMEMBERED = 50_000
#: Characters that the automaton over many words at once knows, and its longest word.
ALPHABET, LONGEST = 191, 64
#: Words that are segmented in step, and characters of text that are encoded at a time.
IN_STEP, VOLUME = 20_000, 6_000_000
#: The most that a model file may have, as it is sent to every executor.
MODEL_BYTES = 64 << 20


class Lockstep:
    """The automaton as tables, to run the Viterbi of many words in step.

    ``move`` leads from a state by a character to the state of the longest
    suffix that begins some piece. ``out`` is the first state on a state's
    suffix chain that ends a piece, ``link`` the next one after it.
    """

    def __init__(self, pieces: dict[str, tuple[int, float]]):
        common = Counter(c for p in pieces for c in set(p)).most_common()
        letters = [c for c, _ in sorted(common, key=lambda x: (-x[1], x[0])) if c in pieces][:ALPHABET]
        self.classes = np.zeros(0x110000, np.uint8)
        self.classes[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        own = {p: v for p, v in pieces.items() if set(p) <= set(letters)}
        children: list[dict[int, int]] = [{}]
        ends: dict[int, tuple[int, int, float]] = {}
        for p, (piece, score) in own.items():
            at = 0
            for c in p:
                c = int(self.classes[ord(c)])
                if c not in children[at]:
                    children[at][c] = len(children)
                    children.append({})
                at = children[at][c]
            ends[at] = (len(p), piece, score)
        n = len(children)
        self.move = np.zeros((n, len(letters) + 1), np.int32)
        self.out, self.link = np.zeros(n, np.int32), np.zeros(n, np.int32)
        self.length, self.piece, self.score = np.zeros(n, np.int64), np.zeros(n, np.int32), np.zeros(n)
        for state, values in ends.items():
            self.length[state], self.piece[state], self.score[state] = values
        queue = [(s, 0) for s in children[0].values()]
        self.move[0, list(children[0])] = list(children[0].values())
        for state, shorter in queue:  # grows while it is walked, by depth
            self.link[state] = self.out[shorter]
            self.out[state] = state if state in ends else self.out[shorter]
            self.move[state] = self.move[shorter]
            for c, child in children[state].items():
                queue.append((child, int(self.move[shorter, c])))
                self.move[state, c] = child

    def best(self, classes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words' best segmentations, one after the other, and their counts.

        ``classes`` holds the characters of words whose sizes do not grow.
        """
        n, most = len(sizes), int(sizes[0])
        text = np.zeros((most, n), np.uint8)
        text.T[np.arange(most)[None, :] < sizes[:, None]] = classes
        score = np.full((most + 1, n), -np.inf)
        score[0] = 0
        back = np.zeros((most + 1, n), np.int32)
        state = np.zeros(n, np.int32)
        for k in range(most):
            live = int(np.searchsorted(-sizes, -k, side="left"))
            state = self.move[state[:live], text[k, :live]]
            rows, ending = np.arange(live), self.out[state]
            while len(rows):
                total = score[k + 1 - self.length[ending], rows] + self.score[ending]
                better = total > score[k + 1, rows]
                score[k + 1, rows[better]] = total[better]
                back[k + 1, rows[better]] = ending[better]
                ending = self.link[ending]
                rows, ending = rows[ending > 0], ending[ending > 0]
        at, steps = sizes.copy(), []
        rows = np.arange(n)
        while len(rows):
            taken = back[at[rows], rows]
            steps.append((rows, self.piece[taken]))
            at[rows] -= self.length[taken]
            rows = rows[at[rows] > 0]
        counts = np.zeros(n, np.int64)
        for rows, _ in steps:
            counts[rows] += 1
        last = np.cumsum(counts)
        ids = np.empty(int(last[-1]), np.int32)
        for k, (rows, piece) in enumerate(steps):
            ids[last[rows] - 1 - k] = piece
        return ids, counts


class Model:
    """The vocabulary of a model file as an automaton over its pieces.

    A segmentation's score is the sum of its pieces' scores, and the best one
    is taken whatever kind of training the file comes from.
    """

    def __init__(self, data: bytes):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(data)
        rules = proto.normalizer_spec
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces:
            raise ValueError("only models that keep the text as it is can be decoded exactly")
        self.prefix = rules.add_dummy_prefix
        self.pieces = [p.piece for p in proto.pieces]
        self.byte_ids = {int(p.piece[1:-1], 16): k for k, p in enumerate(proto.pieces) if p.type == BYTE}
        self.unknown_id = next((k for k, p in enumerate(proto.pieces) if p.type == UNKNOWN), 0)
        self.surface = [
            bytes([int(p.piece[1:-1], 16)]) if p.type == BYTE
            else b"" if p.type in (CONTROL, UNKNOWN)
            else p.piece.replace(SPACE, " ").encode()
            for p in proto.pieces
        ]
        words = {k: p for k, p in enumerate(proto.pieces) if p.type in (NORMAL, USER_DEFINED) and p.piece}
        self.unknown_score = min((p.score for p in words.values()), default=0.0) - UNKNOWN_PENALTY
        self.automaton = ahocorasick.Automaton()
        for k, p in words.items():
            self.automaton.add_word(p.piece, (len(p.piece), k, p.score))
        self.automaton.make_automaton()
        self.empty = not words
        self.singles = frozenset(p.piece for p in words.values() if len(p.piece) == 1)
        self.lengths = [len(p.piece) for p in proto.pieces]
        pattern = self._cuts([p.piece for p in words.values()])
        self.segments = re.compile(pattern).findall
        self.cut_at_words = self.prefix and pattern.endswith(r"|\n") and 10 in self.byte_ids
        self.known: dict[str, tuple[int, ...]] = {}
        self.lockstep = Lockstep({p.piece: (k, p.score) for k, p in words.items()}) if words else None

    @staticmethod
    def _cuts(pieces: list[str]) -> str:
        """A pattern that cuts a text only where no piece goes on across the cut.

        What lies between cuts is segmented by itself, as the best score of a
        text is the sum of the best scores of such parts. The cuts are before
        runs of spaces, at line ends, and where punctuation follows a letter.
        """
        pairs = {pair for p in pieces for pair in zip(p, p[1:], strict=False)}
        if any(b == SPACE != a for a, b in pairs):
            return r"(?s).+"
        line = "" if any("\n" in p for p in pieces) else "\n"
        open_after_letter = {b for a, b in pairs if a.isalpha()}
        marks = "".join(c for c in "!\"#$%&()*+,-./:;<=>?@[]^_{|}~" if c not in open_after_letter)
        stop = re.escape(marks) + SPACE + line
        word = rf"{SPACE}*[^\W\d_]+(?![^{stop}])"
        return rf"{word}|{SPACE}+[^{SPACE}{line}]*|[^{SPACE}{line}]+" + (r"|\n" if line else "")

    def best(self, segment: str) -> tuple[int, ...]:
        """The ids of the best segmentation, in one pass over the characters.

        At each end the automaton gives all pieces that end there, the longest
        first, by its output links, and each relaxes the best score; only a
        better score replaces, so of equal ones the longest last piece stays.
        A character that is no piece relaxes its end by the unknown score.
        """
        n = len(segment)
        score = [0.0] + [-math.inf] * n
        back = [-1] * (n + 1)  # -1: the character before is unknown
        matches = () if self.empty else self.automaton.iter(segment)
        if self.singles.issuperset(segment):
            for last, (length, piece, own) in matches:
                last += 1
                own += score[last - length]
                if own > score[last]:
                    score[last] = own
                    back[last] = piece
        else:
            unknown, at = self.unknown_score, 0
            odd = [k for k, c in enumerate(segment, 1) if c not in self.singles]
            for last, (length, piece, own) in matches:
                while at < len(odd) and odd[at] <= last:  # all pieces that end there have been seen
                    k = odd[at]
                    if score[k - 1] + unknown > score[k]:
                        score[k], back[k] = score[k - 1] + unknown, -1
                    at += 1
                own += score[last + 1 - length]
                if own > score[last + 1]:
                    score[last + 1], back[last + 1] = own, piece
            for k in odd[at:]:
                if score[k - 1] + unknown > score[k]:
                    score[k], back[k] = score[k - 1] + unknown, -1
        out: list[int] = []
        while n:
            piece = back[n]
            if piece >= 0:
                out.append(piece)
                n -= self.lengths[piece]
                continue
            if self.byte_ids:
                out.extend(self.byte_ids[b] for b in reversed(segment[n - 1].encode()))
            else:
                out.append(self.unknown_id)
            n -= 1
        return tuple(reversed(out))

    def _parts(self, marked: str) -> Iterator[int]:
        for segment in self.segments(marked):
            own = self.known.get(segment)
            if own is None:
                own = self.best(segment)
                if len(segment) <= 40:
                    if len(self.known) >= REMEMBERED:
                        self.known.clear()
                    self.known[segment] = own
            yield from own

    def encode(self, text: str) -> list[int]:
        """The ids of one text, segment by segment."""
        marked = text.replace(" ", SPACE)
        return list(self._parts(SPACE + marked if self.prefix else marked)) if text else []

    def words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and counts of words after a space, or after a line end with which they begin."""
        lines = np.fromiter((w.startswith("\n") for w in words), bool, len(words))
        bodies = [w[1:] if line else SPACE + w for w, line in zip(words, lines.tolist(), strict=True)]
        sizes = np.fromiter(map(len, bodies), np.int64, len(bodies))
        classes = self.lockstep.classes[np.frombuffer("".join(bodies).encode("utf-32-le"), np.uint32)]
        starts = np.cumsum(sizes) - sizes
        odd = np.zeros(len(words), bool)
        odd[np.searchsorted(starts, np.flatnonzero(classes == 0), side="right") - 1] = True
        odd |= sizes > LONGEST
        parts: list = [None] * len(words)
        for k in np.flatnonzero(odd).tolist():
            parts[k] = np.fromiter(self._parts(bodies[k]), np.int32)
        plain = np.flatnonzero(~odd & (sizes > 0))
        plain = plain[np.argsort(-sizes[plain], kind="stable")]
        flat, offsets, counts = [np.empty(0, np.int32)], np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        total = 0
        for start in range(0, len(plain), IN_STEP):
            rows = plain[start : start + IN_STEP]
            n = sizes[rows]
            places = np.repeat(starts[rows] - np.cumsum(n) + n, n) + np.arange(n.sum())
            ids, own = self.lockstep.best(classes[places], n)
            flat.append(ids)
            counts[rows], offsets[rows] = own, total + np.cumsum(own) - own
            total += len(ids)
        for k in np.flatnonzero(odd).tolist():
            flat.append(parts[k])
            counts[k], offsets[k] = len(parts[k]), total
            total += len(parts[k])
        ids = np.concatenate(flat)
        # the ids of the words in their order, each line end before its word
        ends = np.cumsum(counts + lines)
        out = np.full(int(ends[-1]) if len(ends) else 0, self.byte_ids.get(10, 0), np.int32)
        own = np.repeat(offsets - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        to = np.repeat(ends - np.cumsum(counts), counts) + np.arange(counts.sum())
        out[to] = ids[own]
        return out, counts + lines

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts and their counts; each distinct word is segmented once."""
        plain = np.fromiter(
            (self.cut_at_words and t != "" and t[0] != " " and "  " not in t and SPACE not in t for t in texts),
            bool, len(texts),
        )
        counts = np.zeros(len(texts), np.int64)
        pieces: list[np.ndarray] = [np.empty(0, np.int32)] * len(texts)
        for k in np.flatnonzero(~plain).tolist():
            pieces[k] = np.array(self.encode(texts[k]), np.int32)
            counts[k] = len(pieces[k])
        rows = np.flatnonzero(plain)
        if len(rows):
            # single spaces and line ends are cuts, so such a text is a row of words
            lists = pc.split_pattern(
                pa.array([texts[k].replace("\n", " \n") for k in rows.tolist()], pa.large_string()), " "
            )
            coded = lists.flatten().dictionary_encode()
            index = coded.indices.to_numpy()
            flat, sizes = self.words(coded.dictionary.to_pylist())
            first, n = (np.cumsum(sizes) - sizes)[index], sizes[index]
            ids = flat[np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())]
            ends = np.r_[0, np.cumsum(n)][lists.offsets.to_numpy()]
            counts[rows] = np.diff(ends)
            if len(rows) == len(texts):
                return ids, counts
            for k, a, b in zip(rows.tolist(), ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                pieces[k] = ids[a:b]
        return np.concatenate(pieces) if pieces else np.empty(0, np.int32), counts

    def decode(self, ids) -> str:
        surface = self.surface
        text = b"".join([surface[i] for i in ids]).decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


def read_model(path: str) -> bytes:
    """The model file at ``path`` on the driver."""
    with open(path, "rb") as file:
        data = file.read(MODEL_BYTES + 1)
    if len(data) > MODEL_BYTES:
        raise ValueError(f"{path} has more than {MODEL_BYTES} bytes")
    return data


def _encoded(shared, check: bool):
    fields = [("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("n_tokens", pa.int64()), ("n_byte_tokens", pa.int64())]
    fields += [("decoded_sha256", pa.string()), ("lossless", pa.bool_())] if check else []
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(shared.value)
        is_byte = np.zeros(len(model.pieces), bool)
        is_byte[list(model.byte_ids.values())] = True
        for got in batches:
            doc_ids, texts = got.column(0).to_pylist(), [t or "" for t in got.column(1).to_pylist()]
            at = 0
            while at < len(texts):
                start, volume = at, 0
                while at < len(texts) and (volume < VOLUME or at == start):
                    volume += len(texts[at])
                    at += 1
                part = texts[start:at]
                ids, counts = model.encode_all(part)
                ends = np.r_[0, np.cumsum(counts)]
                byte_tokens = np.diff(np.r_[0, np.cumsum(is_byte[ids])][ends])
                columns = [doc_ids[start:at], pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids)),
                           pa.array(counts), pa.array(byte_tokens)]
                if check:
                    decoded = [model.decode(ids[a:b].tolist()) for a, b in pairwise(ends.tolist())]
                    columns.append([hashlib.sha256(d.encode()).hexdigest() for d in decoded])
                    columns.append([d == t.replace(SPACE, " ") for d, t in zip(decoded, part, strict=True)])
                yield batch(schema, *columns)

    return run


def encode(docs: DataFrame, model: str) -> DataFrame:
    """``doc_id, ids, n_tokens, n_byte_tokens`` of every row of ``docs(doc_id, text)``.

    ``model`` is the path of a SentencePiece file that leaves texts as they are
    (identity normaliser). NULL and empty texts have no ids. Characters that no
    piece covers become their UTF-8 byte pieces, or the unknown id where the
    file has none. Repeated rows give repeated rows; extra columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_model(model))
    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return rows.mapInArrow(_encoded(shared, False), "doc_id bigint, ids array<int>, n_tokens bigint, n_byte_tokens bigint")


def round_trip(docs: DataFrame, model: str) -> DataFrame:
    """``encode`` with the SHA-256 of the decoded text and whether it equals the text.

    The character U+2581 stands for a space in every piece, so it comes back
    as a space; the comparison reads it so.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_model(model))
    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return rows.mapInArrow(
        _encoded(shared, True),
        "doc_id bigint, ids array<int>, n_tokens bigint, n_byte_tokens bigint, decoded_sha256 string, lossless boolean",
    )


def decode(rows: DataFrame, model: str) -> DataFrame:
    """``doc_id, text`` of ``rows(doc_id, ids)``; NULL ids give an empty text, unknown ids an error."""
    shared = rows.sparkSession.sparkContext.broadcast(read_model(model))
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def run(batches):
        own = Model(shared.value)
        for got in batches:
            ids = [own.decode(i or ()) for i in got.column(1).to_pylist()]
            yield batch(schema, got.column(0).to_pylist(), ids)

    return rows.select(F.col("doc_id").cast("bigint"), F.col("ids").cast("array<int>")).mapInArrow(
        run, "doc_id bigint, text string"
    )
