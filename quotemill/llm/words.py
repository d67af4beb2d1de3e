"""Encodes many texts with the tokenizers library, every distinct word of a portion once.

Texts are cut where no token of the vocabulary reaches across, Arrow numbers the distinct words, the library encodes
those, and the ids of all words are gathered with numpy. Of earlier portions ``REMEMBERED`` words at most are kept, as
Arrow and numpy columns of some 50 bytes a word; when they are more, only the last portion's stay. Else memory is that of
a portion of ``PORTION_BYTES`` of text, or of one text if it is longer.

Two kinds of vocabulary: one that drops white space (``lead=""``, cut at white space), and the byte-level one whose
words carry the blank in front of them (``lead=" "``, cut before a blank that stands before another character; the
first word of a text has none and is encoded by itself).
"""

from __future__ import annotations

import codecs
import os
import re
import string
from collections.abc import Iterator

from quotemill.llm.chunks import cut
from quotemill.shipping import ship_by_value

PORTION_BYTES = 8 << 20
GATHER_WORDS = 1 << 18
REMEMBERED = 400_000
JOINED = 2000  # words that are encoded as one text, a separator between them
LIBRARY_CHARS = 1 << 20
_NO_CUT = r" ([\x00-\x20\x{7f}-\x{a0}\p{Z}]|$)"  # a blank before white space or the end, as broad as any library sees it


LETTERS = string.ascii_letters + "".join(chr(c) for c in range(0xC0, 0x100) if chr(c).isalpha())
# A vocabulary in lower case changes other capitals by rules of its own; words with them are not plain there.
CAPITALS = {ord(c): None for c in LETTERS if c.isupper() and not c.isascii()}

# How byte-level vocabularies write bytes: printable ones as themselves, the others, in order, from U+0100 on.
_SHOWN = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b and b != 0xAD]
_SIGN = dict(zip([*_SHOWN, *(b for b in range(256) if b not in _SHOWN)], [*map(chr, _SHOWN), *map(chr, range(256, 512))]))
BLANK, LINE = _SIGN[0x20], _SIGN[0x0A]
# A blank between words stays; two bytes that no word has stand for the blank in front of a word and the end of a line.
BYTE_SIGNS = "".join({0x01: BLANK, 0x02: LINE, 0x20: " "}.get(b, _SIGN[b]) for b in range(256))


def gather(flat, starts, counts, which):
    """The ids of the words ``which``, one word after the other."""
    import numpy as np

    n = counts[which]
    ends = np.cumsum(n)
    return flat[np.repeat(starts[which] - (ends - n), n) + np.arange(int(ends[-1]) if len(ends) else 0)]


class WordEncoder:
    """``portions(texts)`` yields (number of texts, their ids behind each other, how many each has), in order."""

    def __init__(self, vocabulary: str, lead: str, apart: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import numpy as np
        import pyarrow as pa
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer, self.lead, self.end_id = Tokenizer.from_str(vocabulary), lead, end_id
        self.n_ids = self.tokenizer.get_vocab_size(with_added_tokens=True)
        # The same model without what a word of Latin letters does not need: normalizing, and the pattern.
        self.plain_tokenizer = Tokenizer(self.tokenizer.model)
        self.plain_tokenizer.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        # What marks a word: the token that holds its blank, or the one that ends it.
        suffix = self.tokenizer.model.end_of_word_suffix or ""
        self.marks = np.zeros(self.n_ids, bool)
        for token, number in self.tokenizer.get_vocab(with_added_tokens=False).items():
            self.marks[number] = token.startswith(BLANK) or token == LINE if lead else token.endswith(suffix)
        self.known = pa.array([], pa.string()), np.zeros(0, np.uint32), np.zeros(0, np.int64)
        self.plain = f"^[{LETTERS if lead else LETTERS.translate(CAPITALS)}]+$"
        signs = f"[{re.escape(string.punctuation)}]*"
        lines = lead and self.tokenizer.token_to_id(LINE) is not None
        self.broken = f"^[{LETTERS}]+{signs}\\n+[{LETTERS}]+{signs}$" if lines else None
        between = apart if lead else f" {apart} "
        ids = self.tokenizer.encode(between, add_special_tokens=False).ids
        self.apart, self.between, self.apart_id = apart, between, ids[0] if len(ids) == 1 else None

    def library(self, texts: list[str]) -> list:
        import numpy as np

        out, at = [], 0
        while at < len(texts):  # what the library returns is many times larger than the ids: some at a time
            stop, size = at, 0
            while stop < len(texts) and size < LIBRARY_CHARS:
                size += len(texts[stop]) + 1
                stop += 1
            out += [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts[at:stop], add_special_tokens=False)]
            at = stop
        return out

    def words(self, distinct) -> tuple:
        """(ids, where each word's begin, how many each has) of an Arrow column of words.

        Most words are Latin letters and ASCII signs behind them, which every pattern cuts apart. Their letters, many of
        which return with other signs, go to the library's model in a row. So do those of two such words with ends of lines
        between them, the last of which is a match of its own there. All others go the whole way.
        """
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        def halves(words):
            """(letters, signs) of words that are both."""
            return pc.ascii_rtrim(words, characters=string.punctuation + "\n"), pc.utf8_ltrim(words, characters=LETTERS)

        plain = pc.match_substring_regex(pc.ascii_rtrim(distinct, characters=string.punctuation), self.plain)
        rest = distinct.filter(pc.invert(plain))
        broken = pc.match_substring_regex(rest, self.broken) if self.broken else pc.is_null(rest)
        lines = pc.split_pattern(rest.filter(broken), "\n", max_splits=1, reverse=True).flatten()
        (stems, tails), (line_stems, line_tails) = halves(distinct.filter(plain)), halves(lines)
        second = np.arange(len(lines)) % 2 == 1
        # The second word of a pair has no blank in front but the end of the line, which is part of its name here.
        line_stems = pc.binary_join_element_wise(pa.array(np.where(second, "\n", "")), line_stems, "")
        stems = pa.concat_arrays([stems if self.lead else pc.ascii_lower(stems), line_stems]).dictionary_encode()
        tails = pa.concat_arrays([tails, line_tails]).dictionary_encode()
        which, stem_ids, stem_counts = self.remembered(stems.dictionary)
        tail_ids = self.library(tails.dictionary.to_pylist())
        rest_ids, rest_counts = self.others(rest.filter(pc.invert(broken)).to_pylist())
        sizes = np.concatenate([stem_counts, np.array([len(x) for x in tail_ids], np.int64), rest_counts])
        flat, starts = np.concatenate([stem_ids, *tail_ids, rest_ids]), np.cumsum(sizes) - sizes
        # A plain word is two pieces, its letters and its signs, a broken one four, any other one.
        flags = plain.to_numpy(zero_copy_only=False)
        kind = np.where(flags, 0, 2)
        kind[~flags] -= broken.to_numpy(zero_copy_only=False)
        n_stems, n_tails = len(stem_counts), len(tail_ids)
        pairs = np.stack([which[stems.indices.to_numpy()], n_stems + tails.indices.to_numpy()], axis=1)
        n_plain = len(pairs) - len(lines)
        pieces = np.full((len(flags), 4 if len(lines) else 2), len(sizes), np.int64)
        pieces[kind == 0, :2], pieces[kind == 1] = pairs[:n_plain], pairs[n_plain:].reshape(-1, pieces.shape[1])
        pieces[kind == 2, 0] = n_stems + n_tails + np.arange(len(rest_counts))
        starts, sizes = np.append(starts, 0), np.append(sizes, 0)
        counts = sizes[pieces].sum(axis=1)
        return gather(flat, starts, sizes, pieces.ravel()), np.cumsum(counts) - counts, counts

    def remembered(self, words) -> tuple:
        """(place of each of the distinct words, ids, how many each place has): only words that are not known are encoded."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        known, ids, counts = self.known
        at = pc.index_in(words, value_set=known)
        new = words.filter(pc.is_null(at))
        which = at.fill_null(0).to_numpy().astype(np.int64)
        which[pc.is_null(at).to_numpy(zero_copy_only=False)] = len(known) + np.arange(len(new))
        new_ids, new_counts = self.letters(new.to_pylist())
        known, ids, counts = pa.concat_arrays([known, new]), np.concatenate([ids, new_ids]), np.concatenate([counts, new_counts])
        if len(known) <= REMEMBERED:
            self.known = known, ids, counts
        else:
            self.known = words, gather(ids, np.cumsum(counts) - counts, counts, which), counts[which]
        return which, ids, counts

    def letters(self, words: list[str]) -> tuple:
        """(ids, how many each word has) of words that are one token of the pattern, or an end of line and one behind it."""
        import numpy as np

        groups = [words[k : k + JOINED] for k in range(0, len(words), JOINED)]
        ids, counts = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for k in range(0, len(groups), 8):
            some = groups[k : k + 8]
            first, between = ("\x01", " \x01") if self.lead else ("", " ")
            joined = [(first + between.join(g)).replace("\x01\n", "\x02 ") for g in some]
            texts = [codecs.charmap_decode(t.encode(), "strict", BYTE_SIGNS)[0] for t in joined]
            for group, found in zip(some, self.plain_tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
                ids.append(np.array(found.ids, np.uint32))
                at = np.flatnonzero(self.marks[ids[-1]])
                if len(at) != len(group):
                    raise ValueError("the vocabulary does not mark each word once")
                counts.append(np.diff(at, append=len(ids[-1])) if self.lead else np.diff(at, prepend=-1))
        return np.concatenate(ids), np.concatenate(counts)

    def others(self, words: list[str]) -> tuple:
        """(ids, how many each word has) of any words, a separator between them; words that could meet it go alone."""
        import numpy as np

        odd = [k for k, w in enumerate(words) if self.apart_id is None or self.apart in w or not w or w[-1].isspace() or w[0].isspace()]
        held = dict(zip(odd, self.library([self.lead + words[k] for k in odd])))
        plain = [k for k in range(len(words)) if k not in held]
        groups = [plain[a : a + JOINED] for a in range(0, len(plain), JOINED)]
        out = [held.get(k) for k in range(len(words))]
        for group, ids in zip(groups, self.library([self.between.join([self.lead + words[k] for k in g]) for g in groups])):
            found = np.split(ids, np.flatnonzero(ids == self.apart_id))
            if len(found) != len(group):
                raise ValueError("the vocabulary joins the separator to other text")
            for k, some in zip(group, [found[0], *(x[1:] for x in found[1:])]):
                out[k] = some
        return np.concatenate([np.zeros(0, np.uint32), *out]), np.array([len(x) for x in out], np.int64)

    def cuts(self, texts):
        """The words of every text, as an Arrow list column."""
        import pyarrow as pa
        import pyarrow.compute as pc

        if not self.lead:
            return pc.ascii_split_whitespace(texts)
        odd = pc.match_substring_regex(texts, _NO_CUT)
        if not pc.any(odd).as_py():
            return pc.split_pattern(texts, " ")
        clean, rest = texts.filter(pc.invert(odd)), texts.filter(odd)
        lists = [pc.split_pattern(clean, " "), pa.array([cut(t) for t in rest.to_pylist()], pa.list_(pa.string()))]
        flags = odd.to_numpy(zero_copy_only=False)
        place = (~flags).cumsum() - 1
        place[flags] = len(clean) + flags[flags].cumsum() - 1
        return pa.concat_arrays(lists).take(pa.array(place))

    def portions(self, texts) -> Iterator[tuple]:
        """Of an Arrow string column without nulls."""
        import numpy as np
        import pyarrow.compute as pc

        sizes = pc.binary_length(texts).to_numpy()
        ends, at = np.cumsum(sizes), 0
        while at < len(sizes):
            before = int(ends[at] - sizes[at])
            stop = max(at + 1, int(np.searchsorted(ends, before + PORTION_BYTES, "right")))
            yield from self._portion(texts.slice(at, stop - at))
            at = stop

    def _portion(self, texts) -> Iterator[tuple]:
        import numpy as np

        lists = self.cuts(texts)
        borders = lists.offsets.to_numpy().astype(np.int64)
        borders -= borders[0]
        coded = lists.flatten().dictionary_encode()
        which, distinct = coded.indices.to_numpy().astype(np.int64), coded.dictionary
        fronts = []
        if self.lead:
            first = borders[:-1][np.diff(borders) > 0]
            fronts = self.library(coded.take(first).to_pylist())
            which = which.copy()
            which[first] = len(distinct) + np.arange(len(first))
        flat, starts, counts = self.words(distinct)
        extra = [*fronts, np.array([self.end_id], np.uint32)]
        sizes = np.array([len(x) for x in extra], np.int64)
        starts = np.concatenate([starts, len(flat) + np.cumsum(sizes) - sizes])
        counts, flat = np.concatenate([counts, sizes]), np.concatenate([flat, *extra])
        at = 0
        while at + 1 < len(borders):
            stop = max(at + 1, int(np.searchsorted(borders, borders[at] + GATHER_WORDS, "right")) - 1)
            inner = borders[at : stop + 1] - borders[at]
            some = np.insert(which[borders[at] : borders[stop]], inner[1:], len(counts) - 1)  # the end id is every text's last word
            last = np.cumsum(counts[some])[inner[1:] + np.arange(stop - at)]
            yield stop - at, gather(flat, starts, counts, some), np.diff(last, prepend=0)
            at = stop


ship_by_value(__name__)
