"""Byte-level BPE by prefix dynamic programming.

For every prefix of a byte string exactly one token can be the last one of the prefix's encoding. The table of these
last tokens is filled from left to right: of the vocabulary entries that end at a position (an Aho-Corasick automaton
lists them), the right one is the one that may stand behind the last token of the prefix before it. Whether one token
may follow another is a matter of the two alone. The table of a prefix is the prefix of the table, so text can be
appended, and after an edit only what stands behind it is computed anew, up to the first unchanged match of the
splitting pattern.

Defined cases: a null text is the empty one and has no ids; rows are independent of each other, so repeated rows and
null document ids pass through; texts of any length are encoded whole; special tokens are ordinary text.
"""

from __future__ import annotations

import base64
import itertools
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotemill.llm import chunks
from quotemill.llm.common import kept_in_worker, texts
from quotemill.shipping import ship_by_value

OUT_BYTES = 8 << 20
TEXT_CHARS = 2 << 20  # of text are encoded together
SIDE_BY_SIDE = 64  # bytes; longer matches fill their tables alone


def read_ranks(lines: bytes) -> dict[bytes, int]:
    """token -> rank, from the lines `base64 rank` of a vocabulary file."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines.splitlines())}


def token_list(ranks: dict[bytes, int]) -> list[bytes]:
    out = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, i in ranks.items():
        out[i] = token
    return out


class PrefixBPE:
    """Encodes byte strings (matches of the splitting pattern) and keeps their tables where asked to."""

    def __init__(self, ranks: dict[bytes, int], pairs: int = 1_000_000):
        import ahocorasick
        import numpy as np

        self.ranks = ranks
        self.width = max(ranks.values(), default=0) + 1
        self.longest = max(map(len, ranks), default=1)
        self.tokens = token_list(ranks)
        self.parts: dict[int, tuple[int, int] | None] = {}
        self.follows: dict[int, bool] = {}
        self.pairs = pairs
        self.lengths = np.array([len(t) for t in self.tokens], np.int64)
        self.automaton = ahocorasick.Automaton()
        for token, i in ranks.items():
            self.automaton.add_word(token.decode("latin-1"), i)
        self.automaton.make_automaton()

    def halves(self, i: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes token ``i``; (-1, -1) for a byte, None if merges never make it."""
        if i not in self.parts:
            self.parts[i] = self._halves(self.tokens[i])
        return self.parts[i]

    def _halves(self, token: bytes) -> tuple[int, int] | None:
        if len(token) == 1:
            return -1, -1
        parts = [token[k : k + 1] for k in range(len(token))]
        while len(parts) > 2:
            rank, k = min((self.ranks.get(a + b, self.width), k) for k, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == self.width:
                return None
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return self.ranks[parts[0]], self.ranks[parts[1]]

    def may_follow(self, a: int, b: int) -> bool:
        """Whether token ``b`` can stand behind token ``a`` (-1: first of all): no merge joins bytes of both.

        Merges are undone from the latest one back. At each step the rightmost part of ``a`` and the leftmost part of
        ``b`` are known, and the rank of the merge that consumes each; a merge of the two must not come before.
        """
        key = a * self.width + b
        known = self.follows.get(key)
        if known is None:
            if len(self.follows) >= self.pairs:
                self.follows.clear()
            known = self.follows[key] = self._may_follow(a, b)
        return known

    def _may_follow(self, a: int, b: int) -> bool:
        if a < 0 or self.halves(b) is None:
            return self.halves(b) is not None
        left_until = right_until = self.width
        while True:
            rank = self.ranks.get(self.tokens[a] + self.tokens[b])
            # Of equal ranks the leftmost merge comes first: a part of a is gone by then, a part of b is not.
            if rank is not None and rank < left_until and rank <= right_until:
                return False
            if len(self.tokens[a]) == len(self.tokens[b]) == 1:
                return True
            if len(self.tokens[b]) == 1 or (len(self.tokens[a]) > 1 and a > b):
                left_until, a = a, self.halves(a)[1]
            else:
                right_until, b = b, self.halves(b)[0]

    def extend(self, table: list[int], data: bytes) -> list[int]:
        """Fill the table for all of ``data``; what it holds already (of a prefix) stays."""
        have = len(table) - 1
        table.extend([-1] * (len(data) - have))
        # A token that ends behind the known part may start in it.
        start = max(0, have - self.longest) if have else 0
        width, known, may_follow, shift, tokens = self.width, self.follows.get, self.may_follow, start + 1, self.tokens
        for end, i in self.automaton.iter(data[start:].decode("latin-1")):
            end += shift
            if table[end] < 0:
                last = table[end - len(tokens[i])]
                fits = known(last * width + i)
                if may_follow(last, i) if fits is None else fits:
                    table[end] = i
        return table

    def table(self, data: bytes) -> list[int]:
        """The last token of each prefix; entry 0, of the empty prefix, is -1."""
        return self.extend([-1], data)

    def read_back(self, table: list[int], end: int | None = None) -> list[int]:
        """The encoding of the prefix of length ``end``."""
        end, tokens, out = len(table) - 1 if end is None else end, self.tokens, []
        while end > 0:
            last = table[end]
            out.append(last)
            end -= len(tokens[last])
        out.reverse()
        return out

    def encode(self, data: bytes) -> list[int]:
        """The encoding of one match; a match that is a token is that token."""
        whole = self.ranks.get(data)
        return [whole] if whole is not None else self.read_back(self.table(data))

    def encode_many(self, pieces: list[bytes]) -> list[bytes]:
        """The encodings of many matches, packed; their tables are filled side by side, one position at a time."""
        import numpy as np

        out: list[bytes | None] = [None] * len(pieces)
        waiting = []
        for k, piece in enumerate(pieces):
            whole = self.ranks.get(piece)
            if whole is not None:
                out[k] = whole.to_bytes(4, "little")
            elif len(piece) > SIDE_BY_SIDE:
                out[k] = np.array(self.read_back(self.table(piece)), "<u4").tobytes()
            else:
                waiting.append(k)
        if not waiting:
            return out
        # One string, matches apart by a character that no token has; tables in one array, -1 at each start.
        sizes = np.array([len(pieces[k]) for k in waiting])
        starts = np.concatenate([[0], np.cumsum(sizes[:-1] + 1)])
        text = "\u0100".join([pieces[k].decode("latin-1") for k in waiting])
        found = np.fromiter(itertools.chain.from_iterable(self.automaton.iter(text)), np.int64).reshape(-1, 2)
        ends, ids = found[:, 0] + 1, found[:, 1]
        begins = ends - self.lengths[ids]
        depth = ends - starts[np.searchsorted(starts, ends, "right") - 1]
        order = np.argsort(depth, kind="stable")
        table = np.full(len(text) + 1, -1, np.int64)
        known, width = self.follows.get, self.width
        for these in np.split(order, np.cumsum(np.bincount(depth))[:-1]):
            last, token = table[begins[these]], ids[these]
            fits = list(map(known, (last * width + token).tolist()))
            if None in fits:
                pairs = zip(fits, last.tolist(), token.tolist())
                fits = [self.may_follow(a, b) if f is None else f for f, a, b in pairs]
            right = np.array(fits, bool)
            table[ends[these][right]] = token[right]
        at, owner, taken = starts + sizes, np.arange(len(waiting)), []
        while len(at):
            last = table[at]
            taken.append((owner, at, last))
            at = at - self.lengths[last]
            more = at > starts[owner]
            at, owner = at[more], owner[more]
        owner, at, last = (np.concatenate(x) for x in zip(*taken))
        packed = last[np.lexsort((at, owner))].astype("<u4").tobytes()
        stops = (np.cumsum(np.bincount(owner)) * 4).tolist()
        for k, a, b in zip(waiting, [0, *stops], stops):
            out[k] = packed[a:b]
        return out

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class LiveText:
    """A text under change whose encoding is kept: per match its bytes and its table.

    >>> live = LiveText(bpe, pattern, "a text"); live.append(" and more"); live.replace(2, 6, "word"); live.ids()
    """

    def __init__(self, bpe: PrefixBPE, pattern: str, text: str = ""):
        import regex

        self.bpe, self.split = bpe, regex.compile(pattern).finditer
        self.text, self.starts, self.tables = "", [], []
        self.replace(0, 0, text)

    def append(self, more: str) -> None:
        self.replace(len(self.text), len(self.text), more)

    def replace(self, start: int, end: int, new: str) -> None:
        """Exchange text[start:end]. Matches up to the third before the change cannot see it; they stay."""
        import bisect

        shift = len(new) - (end - start)
        first = max(0, bisect.bisect_left(self.starts, start) - 3)
        origin = self.starts[first] if self.starts else 0
        text = self.text[:start] + new + self.text[end:]
        # Old matches behind the change, by their new start: where a new match starts there too, the rest is the same.
        behind = {s + shift: k for k, s in enumerate(self.starts) if s >= end}
        starts, tables, tail = [], [], len(self.starts)
        for match in self.split(text, origin):
            if match.start() >= start + len(new) and match.start() in behind:
                tail = behind[match.start()]
                break
            data, old = match.group().encode(), first + len(starts)
            table = [-1]
            if old < len(self.starts) and self.starts[old] == match.start() and self.starts[old] < start:
                same = len(self.text[self.starts[old] : start].encode())
                table = self.tables[old][: min(same, len(data), len(self.tables[old]) - 1) + 1]
            starts.append(match.start())
            tables.append(self.bpe.extend(table, data))
        self.starts = self.starts[:first] + starts + [s + shift for s in self.starts[tail:]]
        self.tables = self.tables[:first] + tables + self.tables[tail:]
        self.text = text

    def ids(self) -> list[int]:
        out, ends = [], [*self.starts[1:], len(self.text)]
        for start, end, table in zip(self.starts, ends, self.tables):
            whole = self.bpe.ranks.get(self.text[start:end].encode())
            out.extend([whole] if whole is not None else self.bpe.read_back(table))
        return out


def text_encoder(bpe: PrefixBPE, pattern: str) -> Callable[[list[str]], list[bytes]]:
    """texts -> their ids, each as little-endian unsigned 32-bit integers. Parts seen before are looked up."""
    import regex

    return chunks.PartEncoder(regex.compile(pattern).findall, lambda units: bpe.encode_many([unit.encode() for unit in units]))


def portions(rows: Iterator[tuple], size_at: int, limit: int) -> Iterator[list[tuple]]:
    """Lists of rows whose column ``size_at`` adds up to about ``limit``; a longer row is alone."""
    held, size = [], 0
    for row in rows:
        if held and size + len(row[size_at]) > limit:
            yield held
            held, size = [], 0
        held.append(row)
        size += len(row[size_at]) + 16
    if held:
        yield held


def record_batches(rows: Iterator[tuple], schema, size_at: int) -> Iterator:
    """Record batches of some megabytes from rows; the column at ``size_at`` is the large one."""
    import pyarrow as pa

    for held in portions(rows, size_at, OUT_BYTES):
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)


def vocabulary(spark: SparkSession, path: str):
    """A vocabulary file's bytes (about a megabyte) for the tasks, which need not see the file."""
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def _encoder(held, pattern: str) -> Callable[[list[str]], list[bytes]]:
    return kept_in_worker("bpe/text_encoder", (held.value, pattern), lambda: text_encoder(PrefixBPE(read_ranks(held.value)), pattern))


def _decoder(held) -> Callable[[bytes], bytes]:
    import numpy as np

    tokens = kept_in_worker("bpe/token_list", held.value, lambda: token_list(read_ranks(held.value)))
    return lambda ids: b"".join(map(tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def encode(
    docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False
) -> DataFrame:
    """(doc_id, ids): ids as little-endian unsigned 32-bit integers in one binary.

    With ``decoded`` also the bytes they stand for, decoded in the same task: ids need not travel twice.
    """
    held = vocabulary(docs.sparkSession, ranks_path)
    rows = texts(docs, id_col, text_col)

    def run(batches):
        import pyarrow as pa

        encode_texts, read = _encoder(held, pattern), _decoder(held) if decoded else None
        for batch in batches:
            columns = [("doc_id", batch.schema.field(0).type), ("ids", pa.binary())]
            schema = pa.schema(columns + [("decoded", pa.binary())] * decoded)
            contents = ((i, t.as_py()) for i, t in zip(batch.column(0).to_pylist(), batch.column(1)))
            for some in portions(contents, 1, TEXT_CHARS):
                names, contents_of = zip(*some)
                found = zip(names, encode_texts(contents_of))
                yield from record_batches(((i, ids, read(ids)) for i, ids in found) if decoded else found, schema, 1)

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, ids binary" + ", decoded binary" * decoded)


def decode(encoded: DataFrame, ranks_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, ids, decoded): the bytes that the ids stand for."""
    held = vocabulary(encoded.sparkSession, ranks_path)
    rows = encoded.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(ids_col), F.lit(b"")).alias("ids"))

    def run(batches):
        import pyarrow as pa

        read = _decoder(held)
        for batch in batches:
            schema = pa.schema([("doc_id", batch.schema.field(0).type), ("ids", pa.binary()), ("decoded", pa.binary())])
            found = zip(batch.column(0).to_pylist(), (ids.as_py() for ids in batch.column(1)))
            yield from record_batches(((i, ids, read(ids)) for i, ids in found), schema, 2)

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, ids binary, decoded binary")


ship_by_value(__name__)
