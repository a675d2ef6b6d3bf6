"""Token ids of texts by a public tokenizer, whose file is a parameter."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
import xxhash

#: Distinct words whose ids a worker keeps, the first it meets, and all their ids: under 75 MB.
MOST_WORDS = 1_000_000
MOST_IDS = 8_000_000
#: Bytes of texts whose words are looked up together, which takes about 40 times as much memory.
BLOCK_BYTES = 1 << 19
#: Words that the tokenizer gets at once.
_WORDS_AT_ONCE = 2048
#: Bytes of a word that are hashed by place; longer words are hashed as a whole.
_PLACES = 64
_LETTER, _SIGN, _SPACE = 1, 2, 3
_INDEX_BITS = 21
_INDEX_MASK = np.uint64((1 << _INDEX_BITS) - 1)
_INDEX_SHIFTS = np.uint64(64 - _INDEX_BITS), np.uint64(64 - 2 * _INDEX_BITS)
#: Low bits of an entry's third number, which hold how many ids a word has.
_COUNT_BITS = 31
_SPACES = re.compile(rb"[\t-\r ]")


def read_tokenizer(path: str) -> str:
    """The file's text, read by the driver and sent to the tasks: a few MB."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def _by_word(config: dict) -> bool:
    """Whether white space divides pieces and is dropped, and case is lowered.

    Then a text's ids are those of its words in turn, and lower-casing A-Z first or a
    further space between a letter and a sign that no pattern joins changes nothing.
    """
    steps = (config.get("normalizer") or {}).get("normalizers", [])
    cuts = (config.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
    return (
        [step["type"] for step in steps] == ["NFC", "Replace", "Lowercase"]
        and cuts[0].get("type") == "Split"
        and cuts[0].get("behavior") == "Removed"
        and cuts[0].get("invert") is True
        and cuts[0]["pattern"].get("Regex", "").endswith(r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
    )


class Encoder:
    """Ids of texts, as little-endian unsigned 32-bit integers.

    Where the tokenizer works word by word, the words of many texts are told apart by a
    64-bit hash, their length and their outer bytes, and each distinct word is encoded once.
    """

    def __init__(self, tokenizer_json: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        config = json.loads(tokenizer_json)
        self.by_word = _by_word(config)
        suffix = config["model"].get("end_of_word_suffix")
        del config  # tens of MB, before the tokenizer takes as much
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        kinds = np.zeros(256, np.uint8)
        kinds[list(range(ord("a"), ord("z") + 1))] = _LETTER
        kinds[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'"]] = _SIGN
        kinds[[9, 10, 11, 12, 13, 32]] = _SPACE
        self.kinds = kinds
        # Term of each byte at each place of a word in its hash.
        factors = np.random.default_rng(41).integers(1, 1 << 63, (_PLACES, 1), dtype=np.uint64)
        odd = factors * np.uint64(2) + np.uint64(1)
        self.terms = (odd * np.arange(1, 257, dtype=np.uint64)).ravel()
        vocabulary = self.tokenizer.get_vocab()
        size = max(vocabulary.values(), default=-1) + 1
        self.ends = np.zeros(size, bool)
        if suffix:
            self.ends[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        # Known words: hash, check and where their ids lie in the pool and how many they are;
        # the first is none. Memory is taken as it is filled, so nothing is copied to grow.
        # A word is found by either of two stretches of its hash, and one that finds both
        # places taken is encoded whenever it comes, so that the words that came first stay.
        self.index = np.zeros((2, 1 << _INDEX_BITS), np.int32)
        self.known = 1
        # All of a word lies side by side, so that looking it up touches little memory.
        self.entries = np.zeros((MOST_WORDS + 1, 3), np.int64)
        kind = np.uint16 if size <= 1 << 16 else np.uint32
        self.pool, self.pooled = np.zeros(MOST_IDS + BLOCK_BYTES, kind), 0

    def _encoded(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(one.ids, np.uint32) for one in found]

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct words in an order of their own, and where each word's are and
        how many. Words of letters only are one piece each, whose last id is marked, and
        are encoded many at a time."""
        plain = [i for i, w in enumerate(words) if w.isalpha() and w.lower().isalpha()]
        begins, sizes = np.zeros((2, len(words)), np.int64)
        done = np.zeros(len(words), bool)
        out, total = [], 0
        for at in range(0, len(plain) if self.ends.any() else 0, _WORDS_AT_ONCE):
            own = plain[at : at + _WORDS_AT_ONCE]
            ids = self._encoded([" ".join([words[i] for i in own])])[0]
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) == len(own) and cuts[-1] == len(ids):
                sizes[own] = np.diff(cuts, prepend=0)
                begins[own] = total + cuts - sizes[own]
                done[own] = True
                out.append(ids)
                total += len(ids)
        rest = np.flatnonzero(~done)
        for at in range(0, len(rest), _WORDS_AT_ONCE):
            own = rest[at : at + _WORDS_AT_ONCE]
            for i, ids in zip(own, self._encoded([words[i] for i in own])):
                begins[i], sizes[i] = total, len(ids)
                out.append(ids)
                total += len(ids)
        return np.concatenate(out), begins, sizes

    def _hashes(self, raw, solid, starts, lengths) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero(solid)
        first = np.cumsum(lengths) - lengths
        place = np.arange(len(at)) - np.repeat(first, lengths)
        term = np.minimum(place, _PLACES - 1) * 256 + raw[at]
        keys = np.add.reduceat(self.terms.take(term), first)
        checks = lengths << 16 | raw[starts].astype(np.int64) << 8 | raw[starts + lengths - 1]
        for i in np.flatnonzero(lengths >= _PLACES):
            long = raw[starts[i] : starts[i] + lengths[i]].tobytes()
            keys[i] = xxhash.xxh64_intdigest(long)
        return keys, checks

    def ids(self, texts: Iterable[str | None]) -> list[bytes]:
        raws = [(text or "").encode("utf-8", "replace") for text in texts]
        # A special token is told by its case and place, so its text is encoded whole.
        whole = [i for i, raw in enumerate(raws) if b"<|" in raw or not self.by_word]
        out = [b""] * len(raws)
        for i in whole:
            out[i] = self._encoded([raws[i].decode("utf-8")])[0].astype("<u4").tobytes()
            raws[i] = b""
        parts: list[list[bytes]] = [[] for _ in raws]
        for block in _blocks(raws):
            for (i, _), found in zip(block, self._many([part for _, part in block])):
                parts[i].append(found)
        return [b"".join(found) or out[i] for i, found in enumerate(parts)]

    def _many(self, raws: list[bytes]) -> list[bytes]:
        raw = np.frombuffer(b"\n".join([*raws, b""]).lower(), np.uint8)
        if not len(raw):
            return raws
        kinds = self.kinds[raw]
        # The accented letters of Latin-1 are 0xC3 and one more byte, but for two signs.
        accented = (raw[:-1] == 0xC3) & (raw[1:] != 0x97) & (raw[1:] != 0xB7)
        kinds[1:][accented] = _LETTER
        solid = kinds != _SPACE
        begins = solid.copy()  # a word begins after a space, and at a sign after a letter
        begins[1:] &= ~solid[:-1] | ((kinds[1:] == _SIGN) & (kinds[:-1] == _LETTER))
        stops = solid.copy()
        stops[:-1] &= ~solid[1:] | begins[1:]
        starts = np.flatnonzero(begins)
        if not len(starts):
            return [b""] * len(raws)
        lengths = np.flatnonzero(stops) + 1 - starts
        keys, checks = self._hashes(raw, solid, starts, lengths)
        places, counts = self._looked_up(
            keys, checks, lambda i: raw[starts[i] : starts[i] + lengths[i]].tobytes()
        )
        if places is None:  # two words of one hash: no short cut
            return [x.tobytes() for x in self._encoded([r.decode("utf-8") for r in raws])]
        ends = np.cumsum(counts)
        ids = self.pool[np.repeat(places - ends + counts, counts) + np.arange(ends[-1])]
        # Where each text's words begin among all words, and so its ids among all ids.
        borders = np.cumsum([len(r) + 1 for r in raws[:-1]])
        cuts = np.concatenate([[0], ends])[np.searchsorted(starts, borders)]
        return [part.astype("<u4").tobytes() for part in np.split(ids, cuts)]

    def _looked_up(self, keys, checks, word_at):
        """Place and number of each word's ids in the pool; None if hashes do not suffice."""
        found = self.entries.take(self._slots(keys, 0), axis=0)
        missed = np.flatnonzero(self._other(found, keys, checks))
        again = self.entries.take(self._slots(keys[missed], 1), axis=0)
        there = ~self._other(again, keys[missed], checks[missed])
        found[missed[there]], missed = again[there], missed[~there]
        places, counts = found[:, 2] >> _COUNT_BITS, found[:, 2] & ((1 << _COUNT_BITS) - 1)
        if not len(missed):
            return places, counts
        _, first, word = np.unique(keys[missed], return_index=True, return_inverse=True)
        new = missed[first]
        if (checks[missed] != checks[new][word]).any():
            return None, None
        ids, begins, sizes = self._words([word_at(i).decode("utf-8") for i in new])
        begins += self.pooled
        end = self.pooled + len(ids)
        self.pool = _grown(self.pool, end)
        self.pool[self.pooled : end] = ids
        places[missed], counts[missed] = begins[word], sizes[word]
        # Else these ids are written over next time.
        if self.known + len(new) <= len(self.entries) and end <= MOST_IDS:
            self._keep(keys[new], checks[new], begins, sizes)
            self.pooled = end
        return places, counts

    def _slots(self, keys: np.ndarray, n: int) -> np.ndarray:
        """The entry that the n-th index has for each word, 0 for none."""
        place = (keys >> _INDEX_SHIFTS[n]) & _INDEX_MASK
        return self.index[n].take(place.view(np.int64))

    @staticmethod
    def _other(entries, keys, checks) -> np.ndarray:
        """Whether an entry is not that of the word; no word's check is 0, as an empty one's."""
        return (entries[:, 0] != keys.view(np.int64)) | (entries[:, 1] != checks)

    def _keep(self, keys, checks, begins, sizes) -> None:
        entry = np.arange(self.known, self.known + len(keys), dtype=np.int32)
        self.known += len(keys)
        found = begins << _COUNT_BITS | sizes
        self.entries[entry] = np.stack([keys.view(np.int64), checks, found], axis=1)
        for index, shift in zip(self.index, _INDEX_SHIFTS):
            slot = ((keys >> shift) & _INDEX_MASK).view(np.int64)
            free = index[slot] == 0
            index[slot[free]] = entry[free]
            left = index[slot] != entry
            keys, entry = keys[left], entry[left]


def _grown(array: np.ndarray, size: int) -> np.ndarray:
    """The array, or a longer one that starts with it, of at least ``size``."""
    if size <= len(array):
        return array
    return np.concatenate([array, np.zeros(size - len(array), array.dtype)])


def _blocks(raws: list[bytes]) -> Iterator[list[tuple[int, bytes]]]:
    """Numbered texts in lists of about BLOCK_BYTES; a text is cut at white space only."""
    block, room = [], BLOCK_BYTES
    for number, raw in enumerate(raws):
        at = 0
        while at < len(raw):
            space = _SPACES.search(raw, at + room)
            end = space.start() if space else len(raw)
            block.append((number, raw[at:end]))
            room -= end - at
            at = end
            if room <= 0:
                yield block
                block, room = [], BLOCK_BYTES
    if block:
        yield block


def kept_encoder(holder: dict) -> Encoder:
    """The encoder of ``holder["json"]``, made once for each worker that got the holder."""
    if "encoder" not in holder:
        holder["encoder"] = Encoder(holder["json"])
    return holder["encoder"]
