"""Look up the ids of a text's chunks instead of matching its pre-tokens again.

A space or newline between two characters that aren't white space begins a new
match of the pre-token pattern whatever stands around it, and so does a
punctuation mark after a letter. A text's pre-tokens are those of its chunks
between such places, in order.

A chunk's key is the chunk without its leading space; a chunk that begins with
a newline is its own key, and one with neither (a text's first) has "\\0" in
front.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

_PLACE = re.compile(r"(?<=\S)(?=[ \n]\S)")
#: What else str.isspace() holds for.
_OTHER_SPACE = "\t\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(
    map(chr, range(0x2000, 0x200B))
)
_RUNS = ("  ", "\n\n", " \n", "\n ")
_MARKS = frozenset(".,;:!?")


def keys(text: str) -> list[str]:
    """Keys of the text's chunks, in order."""
    if "\0" in text:
        return ["\0" + text]
    if any(x in text for x in _RUNS) or any(x in text for x in _OTHER_SPACE):
        first, *rest = _PLACE.split(text)
        return ["\0" + first, *(x[1:] if x[0] == " " else x for x in rest)]
    parts = text.replace("\n", " \n").split(" ")
    if not parts[0]:
        return parts[1:]
    parts[0] = "\0" + parts[0]
    return parts


def chunk(key: str) -> str:
    """The chunk of a key."""
    if key[:1] == "\0":
        return key[1:]
    return key if key[:1] == "\n" else " " + key


def _halves(key: str) -> tuple[str, str] | None:
    """Two keys whose chunks make up this key's, where a match always ends."""
    if len(key) > 2 and key[-1] in _MARKS and key[-2].isalpha():
        return key[:-1], "\0" + key[-1]
    if len(key) > 1 and key[0] == "\n" and not key[1].isspace():
        return "\n", "\0" + key[1:]
    return None


class ChunkIds:
    """Ids of texts, by way of a bounded cache of their chunks' ids.

    ``encode`` gives the ids of chunks, each as bytes. The cache has two
    generations, of ``size`` characters of keys (100 more a key) each: the
    elder goes when the younger is full.
    """

    def __init__(self, encode: Callable[[list[str]], list[bytes]], size: int):
        self.encode, self.size, self.load, self.new, self.old = encode, size, 0, {}, {}

    def _learn(self, lost: set[str]) -> None:
        new, old = self.new, self.old
        plan, atoms = [], set()
        wanted = list(lost)
        for k in wanted:  # grows by the halves of keys
            if k in new:
                continue
            known = old.get(k)
            if known is not None:
                new[k] = known
            elif halves := _halves(k):
                plan.append((k, halves))
                wanted += [h for h in halves if h not in new and h not in atoms]
            else:
                atoms.add(k)
        self.load += sum(map(len, wanted)) + 100 * len(wanted)
        todo = list(atoms)
        for lo in range(0, len(todo), 20_000):
            part = todo[lo : lo + 20_000]
            new.update(zip(part, self.encode([chunk(k) for k in part]), strict=True))
        for k, (a, b) in reversed(plan):  # halves come after their keys
            new[k] = new[a] + new[b]

    def of(self, texts: list[str]) -> list[bytes]:
        if self.load > self.size:
            self.old, self.new, self.load = self.new, {}, 0
        new, get = self.new, self.new.get
        out: list[bytes | None] = []
        wait, lost = [], set()
        for t in texts:
            ks = keys(t)
            found = list(map(get, ks))
            if None in found:
                miss = [i for i, v in enumerate(found) if v is None]
                wait.append((len(out), ks, found, miss))
                lost.update([ks[i] for i in miss])
                out.append(None)
            else:
                out.append(b"".join(found))
        self._learn(lost)
        for at, ks, found, miss in wait:
            for i in miss:
                found[i] = new[ks[i]]
            out[at] = b"".join(found)
        return out


def text_groups(texts: list[str | None], most: int) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts of about ``most`` characters: (first index, texts); null is empty."""
    group, first, load = [], 0, 0
    for i, t in enumerate(texts):
        t = t or ""
        if group and load + len(t) > most:
            yield first, group
            group, first, load = [], i, 0
        group.append(t)
        load += len(t)
    if group:
        yield first, group
