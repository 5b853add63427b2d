"""Work on texts by their distinct words: a batch of texts becomes one array of word numbers.

Splitting, numbering and looking up run in Arrow and numpy; only what is done with a word that a task has not met yet
costs more. A text is cut in front of single spaces whose two neighbours are plain (letters, digits or visible ASCII).
What stands between two cuts is a word with its leading space; runs of white space, and whatever lies beside them, stay
in one word with their neighbours. For a tokenizer that never joins across such a cut, the tokens of a text are those
of its words in a row.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Characters beside which a space is a cut, as a regular expression.
PLAIN = r"[\pL\pN!-~]"


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """``words, numbers, ends``: the distinct words, the word number of each occurrence, and where each text ends
    among the occurrences. A null or empty text has no words; joined, the words of a text are the text."""
    texts = pc.fill_null(texts, "")
    lists = pc.split_pattern(texts, " ")
    ends = lists.offsets.to_numpy()
    ends = ends[1:] - ends[0]
    coded = lists.flatten().dictionary_encode()
    raw, code = coded.dictionary, coded.indices.to_numpy()
    if not len(code):
        return raw, code, ends
    opens = np.zeros(len(code), bool)  # the first part of a text, which no space precedes
    opens[np.r_[0, ends[:-1]][np.diff(np.r_[0, ends]) > 0]] = True
    starts, stops = (pc.match_substring_regex(raw, p).to_numpy(zero_copy_only=False) for p in (rf"\A{PLAIN}", rf"{PLAIN}\z"))
    cut = opens.copy()
    cut[1:] |= starts[code[1:]] & stops[code[:-1]]
    first = np.flatnonzero(cut)
    length = np.diff(first, append=len(code))
    single = length == 1
    place, bare = np.zeros((2, len(raw)), np.int32), opens[first].astype(np.int8)
    alone = code[first]
    place[bare[single], alone[single]] = 1
    used = [np.flatnonzero(p) for p in place]
    place[0, used[0]], place[1, used[1]] = np.arange(len(used[0])), len(used[0]) + np.arange(len(used[1]))
    out = place[bare, alone]
    spaced = pc.binary_join_element_wise(pa.scalar(" "), raw.take(pa.array(used[0])), pa.scalar(""))
    words = [spaced, raw.take(pa.array(used[1]))]
    wide = np.flatnonzero(~single)
    if len(wide):
        parts = raw.take(pa.array(gather(code, first[wide], length[wide])))
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(length[wide])], pa.int32()), parts), " ")
        texts = pc.binary_join_element_wise(pc.if_else(pa.array(bare[wide] == 1), "", " "), joined, pa.scalar("")).dictionary_encode()
        out[wide] = sum(map(len, words)) + texts.indices.to_numpy()
        words.append(texts.dictionary)
    whole = pa.concat_arrays(words)
    ends = np.searchsorted(first, ends)
    empty = np.flatnonzero(pc.equal(whole, "").to_numpy(zero_copy_only=False))
    if len(empty):  # an empty text
        keep = np.ones(len(whole), bool)
        keep[empty] = False
        kept = keep[out]
        ends = np.r_[0, np.cumsum(kept)][ends]
        out = (np.cumsum(keep) - 1)[out[kept]]
        whole = whole.filter(pa.array(keep))
    return whole, out, ends


class WordLists:
    """A growing table of integer lists, one per word, kept over the batches of a task.

    ``encode(words)`` gives the flat numbers and the length of each word's list, for an array of words. A table beyond
    ``limit`` numbers is dropped and built anew, with the same results; words of more than ``longest`` bytes never
    enter it.
    """

    def __init__(self, encode: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]], limit: int = 2_000_000, longest: int = 64) -> None:
        self.encode, self.limit, self.longest = encode, limit, longest
        self.clear()

    def clear(self) -> None:
        self.known = pa.array([], pa.string())
        self.flat, self.start = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def lists(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``flat, starts, lengths``: where to find the list of each word."""
        if len(self.flat) > self.limit:
            self.clear()
        at = pc.index_in(words, value_set=self.known)
        new = pc.is_null(at).to_numpy(zero_copy_only=False)
        at = pc.fill_null(at, 0).to_numpy().astype(np.int64)
        if not new.any():
            return self.flat, self.start[at], self.start[at + 1] - self.start[at]
        fresh = words.filter(pa.array(new))
        short = pc.less_equal(pc.binary_length(fresh), self.longest).to_numpy(zero_copy_only=False)
        order = np.r_[np.flatnonzero(short), np.flatnonzero(~short)]  # what stays comes first
        fresh = fresh.take(pa.array(order))
        flat, lengths = self.encode(fresh)
        at[np.flatnonzero(new)[order]] = len(self.known) + np.arange(len(fresh))
        kept = int(short.sum())
        start = np.r_[self.start, self.start[-1] + np.cumsum(lengths)]
        whole = np.concatenate([self.flat, flat.astype(np.int32)])
        self.known = pa.concat_arrays([self.known, fresh.slice(0, kept)])
        self.start = start[:len(self.start) + kept]
        self.flat = whole[:self.start[-1]]
        return whole, start[at], start[at + 1] - start[at]

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The flat numbers of all texts and how many each has."""
        words, numbers, ends = split_words(texts)
        if not len(words):
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        flat, start, length = self.lists(words)
        first, n = start[numbers], length[numbers]
        total = np.r_[0, np.cumsum(n)]
        return gather(flat, first, n), np.diff(total[ends], prepend=0)


def gather(flat: np.ndarray, first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The stretches ``flat[first:first + n]`` in a row."""
    if not len(n):
        return flat[:0]
    shift = np.repeat(first - np.r_[0, np.cumsum(n)[:-1]], n)
    return flat[shift + np.arange(len(shift))]
