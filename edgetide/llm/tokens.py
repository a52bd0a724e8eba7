"""Token ids of whole texts, with the ids of frequent pieces kept at hand.

The byte-level tokenizer splits a text into pieces before it merges bytes. A single space or line
end between two other characters always starts a piece, and so does punctuation between a letter
or digit and a space. A text cut there encodes to the concatenation of its cuts' ids, and a cut
seen before need not be encoded again. Texts with any other white space are encoded whole.
"""

import os
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

END_ID = 0
REMEMBERED = 600_000
GROUP_CHARS = 1 << 22
ROWS = 1024
JOINED = 256

# White space other than the blank and the line end.
_OTHER_SPACE = r"[\t\x0b\x0c\r\x1c-\x1f\x{85}\pZ]"
# Punctuation behind a word becomes a cut of its own, marked by a NUL.
_BEHIND = (r"([\pL\pN])([.,!?;:#$%&*|]+)( |$)", "\\1 \0\\2\\3")


def default_tokenizer() -> str:
    """The tokenizer file's place on the machine that calls this."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """texts -> ids as little-endian 32-bit integers.

    ``path`` None takes the default file. Cuts are kept in two tables of about ``remembered``
    entries: a full one takes the place of the other, from which cuts in use are taken back. What
    is forgotten costs time and changes nothing else.
    """

    def __init__(self, path: str | None = None, remembered: int = REMEMBERED):
        # tasks share the cores already; set before the library starts threads of its own
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self._tokenizer = Tokenizer.from_file(path or default_tokenizer())
        self._remembered = remembered
        self._known: dict[str, bytes] = {}
        self._before: dict[str, bytes] = {}
        (self._line_end,) = self._whole(["\n"])

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, "<u4").tobytes() for x in found]

    def _learn(self, cuts: list[str]) -> None:
        """Encode new cuts, many in one string with a line end behind each."""
        alone = [cut for cut in cuts if len(self._line_end) != 4 or cut[0] in "\n\0"]
        plain = [cut.lstrip("\0") if cut[0] in "\n\0" else " " + cut for cut in alone]
        self._known.update(zip(alone, self._whole(plain), strict=True))
        spaced = [cut for cut in cuts if cut not in self._known]
        chunks = [spaced[i : i + JOINED] for i in range(0, len(spaced), JOINED)]
        strings = [" " + "\n ".join(chunk) + "\n" for chunk in chunks]
        mark = int.from_bytes(self._line_end, "little")
        for chunk, packed in zip(chunks, self._whole(strings), strict=True):
            ends = (np.flatnonzero(np.frombuffer(packed, "<u4") == mark) * 4).tolist()
            start = 0
            for cut, end in zip(chunk, ends, strict=True):
                self._known[cut] = packed[start:end]
                start = end + 4

    def _ids_of(self, cuts: list[str]) -> list[bytes]:
        """The ids of distinct cuts."""
        known, before = self._known, self._before
        found = list(map(known.get, cuts))
        new = [cut for cut, ids in zip(cuts, found, strict=True) if ids is None]
        if not new:
            return found
        if len(known) + len(new) > self._remembered:
            before = self._before = known
            known = self._known = {}
            new = cuts
        known.update((cut, before[cut]) for cut in new if cut in before)
        new = [cut for cut in new if cut not in known]
        if new:
            self._learn(new)
        return list(map(known.__getitem__, cuts))

    def _group(self, texts: list[str]) -> list[bytes]:
        spaced = pc.replace_substring(pa.array(texts, pa.large_string()), "\n", " \n")
        lists = pc.split_pattern(pc.replace_substring_regex(spaced, *_BEHIND), " ")
        coded = lists.flatten().dictionary_encode()
        at, cuts = coded.indices.to_numpy(), coded.dictionary
        starts = lists.offsets.to_numpy()
        # two blanks in a row, one at an end, or white space of another kind: not cut here
        odd = np.array(
            pc.or_(
                pc.or_(pc.equal(cuts, ""), pc.equal(cuts, "\n")),
                pc.match_substring_regex(cuts, _OTHER_SPACE),
            )
        )
        # as objects of numpy, which takes a tenth of the time of Arrow's own list
        names = cuts.to_numpy(zero_copy_only=False).tolist()
        heads = [names[i] for i in at[starts[:-1]].tolist()]
        whole = np.add.reduceat(odd[at], starts[:-1]) > 0
        whole |= [h[:1] == "\n" or "\0" in text for h, text in zip(heads, texts, strict=True)]
        inside = np.zeros(len(names), bool)
        body = np.ones(len(at), bool)
        body[starts[:-1]] = False
        body &= ~np.repeat(whole, np.diff(starts))
        inside[at[body]] = True
        used = np.flatnonzero(inside)
        ids = self._ids_of([names[i] for i in used.tolist()])
        sizes = np.zeros(len(names), np.int64)
        sizes[used] = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        first = np.concatenate(([0], np.cumsum(sizes)))[:-1]
        pool = np.frombuffer(b"".join(ids), "<u4")
        # the ids of all cuts one after the other
        wanted = at[body]
        lengths = sizes[wanted]
        ends = np.cumsum(lengths)
        spread = np.repeat(first[wanted] - (ends - lengths), lengths)
        packed = pool[spread + np.arange(len(spread))].tobytes()
        before = np.concatenate(([0], np.cumsum(body)))[starts]
        bound = (np.concatenate(([0], ends))[before] * 4).tolist()
        fronts = self._whole([text if w else h for text, h, w in zip(texts, heads, whole, strict=True)])
        return [
            front + packed[bound[i] : bound[i + 1]] if not whole[i] else front
            for i, front in enumerate(fronts)
        ]

    def __call__(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """The ids of each text, in order; none for null or empty."""
        group: list[str] = []
        chars = 0
        for text in texts:
            group.append(text or "")
            chars += len(group[-1])
            if chars >= GROUP_CHARS:
                yield from self._group_with_empty(group)
                group, chars = [], 0
        yield from self._group_with_empty(group)

    def _group_with_empty(self, texts: list[str]) -> Iterator[bytes]:
        full = [text for text in texts if text]
        found = iter(self._group(full) if full else ())
        return (next(found) if text else b"" for text in texts)


@lru_cache(maxsize=1)
def shared_encoder(path: str | None) -> Encoder:
    """One encoder for all tasks of a worker process."""
    return Encoder(path)


def encoded(batches: Iterator[pa.RecordBatch], path: str | None) -> Iterator[tuple]:
    """(doc_id, ids and end id as bytes) for each row of (doc_id, text), a few rows at a time."""
    encoder = shared_encoder(path)
    end = np.array([END_ID], "<u4").tobytes()
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            rows = batch.slice(start, ROWS)
            texts = rows.column("text").to_pylist()
            for doc_id, ids in zip(rows.column("doc_id").to_pylist(), encoder(texts), strict=True):
                yield doc_id, ids + end
