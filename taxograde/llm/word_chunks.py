"""Cached encoding of whole texts, chunk by chunk, for byte-level tokenizers.

The byte-level pattern never joins a space that precedes a non-space character
to what stands before it, so a text can be cut before every such space and the
chunks encoded apart. ``ChunkEncoder`` keeps the ids of recent chunks; a chunk
that is not kept is handed to ``encode_many``. A text in which a space is
followed by white space or by its end, or which holds a special token's string,
is encoded whole.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Chunks kept by one Python worker; two generations of this many at most.
KEPT = 200_000
HEADS = 20_000
_TAIL = ".,!?;:"
_CUT = re.compile(r"[^\s] (?=\S)")


class ChunkEncoder:
    """``encode_many(list of str) -> list of id sequences`` (or of their bytes) with a bounded cache."""

    def __init__(self, encode_many: Callable[[list[str]], list], specials: list[str] = (), kept: int = KEPT):
        self.encode_many, self.specials, self.kept = encode_many, list(specials), kept
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.heads: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {}  # runs of signs that end a piece

    def _packed(self, texts: list[str]) -> list[bytes]:
        return [ids if isinstance(ids, bytes) else np.asarray(ids, dtype="<u4").tobytes() for ids in self.encode_many(texts)]

    def _head(self, head: str) -> bytes:
        """The ids of a text's first piece, which no space precedes."""
        ids = self.heads.get(head)
        if ids is None:
            if len(self.heads) > HEADS:
                self.heads = {}
            ids = self.heads[head] = self._packed([head])[0]
        return ids

    def _add(self, missing: list[str]) -> None:
        """Keep the ids of `` piece`` for each missing piece."""
        if len(self.new) > self.kept:
            self.old, self.new = self.new, {}
        new, old = self.new, self.old
        ask, made = [], []
        for p in dict.fromkeys(missing):
            if (ids := old.get(p)) is not None:
                new[p] = ids
            elif p[-1] in _TAIL and (b := p.rstrip(_TAIL)) and len(b) > len(p) - 8 and b[-1].isalnum():
                # a sign after a letter or digit begins a new token
                made.append((p, b))
                if b not in new:
                    if (ids := old.get(b)) is not None:
                        new[b] = ids
                    else:
                        ask.append(b)
                if (t := p[len(b):]) not in self.tails:
                    self.tails[t] = self._packed([t])[0]
            else:
                ask.append(p)
        ask = list(dict.fromkeys(ask))
        new.update(zip(ask, self._packed([" " + p for p in ask])))
        for p, b in made:
            new[p] = new[b] + self.tails[p[len(b):]]

    def _plain(self, text: str) -> bytes:
        head, *pieces = text.split(" ")
        get = self.new.get
        found = list(map(get, pieces))
        if None in found:
            missing = [p for p, ids in zip(pieces, found) if ids is None]
            if any(not p or p[0].isspace() for p in missing):
                return self._packed([text])[0]
            self._add(missing)
            new = self.new
            found = [new[p] if ids is None else ids for p, ids in zip(pieces, found)]
        if head:
            found.insert(0, self._head(head))
        return b"".join(found)

    def encode(self, text: str, part: int = 1_000_000) -> bytes:
        """The ids of ``text`` as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if any(s in text for s in self.specials):
            return self._packed([text])[0]
        if len(text) <= part:
            return self._plain(text)
        return b"".join(self._plain(x) for x in _parts(text, part))

    def _plain_all(self, texts: list[str]) -> list[bytes]:
        """``_plain`` of each text; a piece that stands in several places is looked up once."""
        lists = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        off = lists.offsets.to_numpy().astype(np.int64)
        pieces = lists.values.dictionary_encode()
        at, names = pieces.indices.to_numpy().astype(np.int64), pieces.dictionary.to_pylist()
        heads = [names[i] for i in at[off[:-1]]]
        at[off[:-1]] = len(names) + np.arange(len(texts))
        used = np.zeros(len(names) + len(texts), bool)
        used[at] = True
        kept = list(map(self.new.get, names))
        missing = [i for i, ids in enumerate(kept) if ids is None and used[i]]
        odd = np.zeros(len(used), bool)  # pieces whose texts are encoded whole
        odd[[i for i in missing if not names[i] or names[i][0].isspace()]] = True
        missing = [i for i in missing if not odd[i]]
        if missing:
            self._add([names[i] for i in missing])
            for i in missing:
                kept[i] = self.new[names[i]]
        ids = pa.array([*kept, *(self._head(head) if head else b"" for head in heads)], pa.large_binary()).take(pa.array(at))
        ends = np.frombuffer(ids.buffers()[1], np.int64)[ids.offset:][off].tolist()
        data = (ids.buffers()[2] or pa.py_buffer(b"")).to_pybytes()
        whole = np.logical_or.reduceat(odd[at], off[:-1]).tolist()
        return [self._packed([text])[0] if w else data[x:z] for text, w, x, z in zip(texts, whole, ends, ends[1:])]

    def encode_all(self, texts: list[str], part: int = 1_000_000) -> list[bytes]:
        """``encode`` of each of some texts, of about ``part`` characters in all or a single longer one."""
        plain = [i for i, t in enumerate(texts) if 0 < len(t) <= part and not any(s in t for s in self.specials)]
        done = dict(zip(plain, self._plain_all([texts[i] for i in plain]) if plain else []))
        return [done[i] if i in done else self.encode(t, part) for i, t in enumerate(texts)]


def _parts(text: str, size: int) -> Iterator[str]:
    """Consecutive parts of a long text, cut before spaces between non-space characters."""
    lo = 0
    while m := _CUT.search(text, lo + size):
        yield text[lo:m.start() + 1]
        lo = m.start() + 1
    yield text[lo:]
