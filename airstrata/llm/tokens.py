"""Token ids of whole texts by the tokenizers library, with met pieces remembered."""

import json
import os
import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np

ID_BYTES = 4
KEPT = 100  # characters of the longest piece that is remembered
PORTION = 1 << 17  # characters that are looked up together
SLOT_BITS = 21  # 64 MB of slots for each worker
# A blank before white space or the end starts no piece; MARK stands for it while words are cut.
INNER_BLANK = re.compile(r" (?=\s|$)")
MARK = "\x01"
# A blank that is followed by no white space starts a new pre-token, whatever
# stands before it: the pattern's white-space rule leaves that blank to the word.
PIECE_START = re.compile(r"(?=(?<!^) (?!\s|$))")
# Letters of every Unicode version. A sign, digit or the end must follow the run.
LETTERS = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+")
SIGNS = re.compile(r"[!-/:-@\[-`{-~]{1,3}")
BLANK = chr(256 + 32)


def byte_letters() -> dict[int, str]:
    """The printable character that byte-level models write for each byte (public rule)."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in printable}
    for n, b in enumerate(b for b in range(256) if b not in letters):
        letters[b] = chr(256 + n)
    return letters


def load(path: str):
    """The tokenizer of a file, for one thread."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class WordTable:
    """Ids of words of at most 24 UTF-8 bytes (none NUL), looked up by arrays.

    An open hash table in one array: three numbers hold the word itself, so equal
    keys are equal words; the fourth holds the place and number of its ids.
    """

    LETTERS = 24

    def __init__(self, bits: int):
        self.bits = bits
        self.clear()

    def clear(self) -> None:
        self.slots = np.zeros((1 << self.bits, 4), np.uint64)
        self.ids = np.zeros(1 << 20, "<u4")
        self.words = self.used = 0

    def make_room(self, words: int) -> None:
        """Start anew if so many more words would fill three quarters."""
        if self.words + words > 3 << self.bits - 2:
            self.clear()

    @staticmethod
    def keys(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The words' bytes as rows of three numbers; 24 bytes must follow the last word."""
        eights = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
        masks = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
        out = np.empty((len(starts), 3), np.uint64)
        for j in range(3):
            out[:, j] = eights[np.minimum(starts + 8 * j, len(eights) - 1)]
            out[:, j] &= masks[np.clip(sizes - 8 * j, 0, 8)]
        return out

    def first(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys[:, 0] * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= keys[:, 1] * np.uint64(0xC2B2AE3D27D4EB4F)
        mixed ^= keys[:, 2] * np.uint64(0x165667B19E3779F9)
        mixed ^= mixed >> np.uint64(31)
        mixed *= np.uint64(0xFF51AFD7ED558CCD)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Per word its fourth number, 0 if it is not here."""
        at = self.first(keys)
        out, same = self.held(at, keys)
        open_ = np.flatnonzero(~same & (out != 0))  # few: most slots hold the word, or nothing
        out[open_] = 0
        at = at.take(open_)
        while len(open_):
            at = (at + 1) & ((1 << self.bits) - 1)
            found, same = self.held(at, keys.take(open_, axis=0))
            out[open_[same]] = found[same]
            go = ~same & (found != 0)
            open_, at = open_[go], at[go]
        return out

    def held(self, at: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The fourth numbers in the slots, and whether the words there are the keys."""
        rows = self.slots.take(at, axis=0)
        same = rows[:, 0] == keys[:, 0]
        same &= rows[:, 1] == keys[:, 1]
        same &= rows[:, 2] == keys[:, 2]
        return rows[:, 3].copy(), same

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Different words that are not here yet."""
        at, open_ = self.first(keys), np.arange(len(keys))
        self.words += len(keys)
        while len(open_):
            free = self.slots[at, 3] == 0
            spots, who = at[free], open_[free]
            self.slots[spots, 3] = values[who]
            won = self.slots[spots, 3] == values[who]  # values differ, so one wins a slot
            self.slots[spots[won], :3] = keys[who[won]]
            go = np.ones(len(open_), bool)
            go[np.flatnonzero(free)[won]] = False
            open_, at = open_[go], (at[go] + 1) & ((1 << self.bits) - 1)

    def append(self, ids: np.ndarray) -> int:
        """Put ids behind those in use; where they begin."""
        start, self.used = self.used, self.used + len(ids)
        if self.used > len(self.ids):
            grown = np.zeros(max(2 * len(self.ids), self.used), "<u4")
            grown[:start] = self.ids[:start]
            self.ids = grown
        self.ids[start : self.used] = ids
        return start


class TextEncoder:
    """Ids of texts as the library gives them, as little-endian unsigned 32-bit bytes.

    With a byte-level model that splits by its usual pattern, a text falls into
    pieces, each a blank with the following non-blank run, whose ids do not depend
    on their surroundings. Ids of met pieces are kept (``limit`` at most; then they become
    the old ones, from which those met again return), and the library encodes the others of a text
    together. Any other tokenizer, and any text that holds one of its added tokens, is encoded whole.
    """

    def __init__(self, path: str, limit: int = 100_000, bits: int = SLOT_BITS):
        self.tokenizer = load(path)
        self.limit = limit
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        pre = parts.get("pre_tokenizer") or {}
        self.by_piece = (
            parts.get("normalizer") is None
            and pre.get("type") == "ByteLevel"
            and pre.get("use_regex", True)
            and not pre.get("add_prefix_space")
            and parts["model"].get("type") == "BPE"
            and not parts["model"].get("dropout")
            and all(
                not t.get("lstrip") and not t.get("rstrip") and " " not in t["content"]
                for t in parts["added_tokens"]
            )
        )
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.opens = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.opens[[i for token, i in vocabulary.items() if token.startswith(BLANK)]] = True
        self.letters = byte_letters()
        self.model = self.tokenizer.model
        self.words: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.rests: dict[str, bytes] = {"": b""}
        self.table = WordTable(bits)

    def whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return array("I", ids).tobytes()

    def piece(self, text: str) -> bytes:
        """A piece. A first run of letters before a sign or digit is one pre-token."""
        blank = text[:1] == " "
        found = LETTERS.match(text, 1 if blank else 0)
        if not found or not text[found.end() :][:1].isascii():
            return self.rest(text)
        head, rest = text[: found.end()], text[found.end() :]
        if head.isascii():
            head = BLANK + head[1:] if blank else head
        else:
            head = head.encode().decode("latin-1").translate(self.letters)
        ids = array("I", [t.id for t in self.model.tokenize(head)]).tobytes()
        return ids + self.rest(rest) if rest else ids

    def rest(self, text: str) -> bytes:
        ids = self.rests.get(text)
        if ids is None:
            ids = self.whole(text)
            if len(text) <= KEPT:
                if len(self.rests) >= self.limit:
                    self.rests = {"": b""}
                self.rests[text] = ids
        return ids

    def learn(self, missing: list[str]) -> None:
        """Keep the ids of words, each the piece that a blank and the word make.

        Those without a blank inside go through the library in one text: in its
        ids, just the first of each piece is of a token that begins with a blank.
        """
        new = []
        for w in missing:
            ids = self.old.get(w)
            if ids is not None:
                self.words[w] = ids
            elif " " in w:
                self.words[w] = self.piece(" " + w)
            else:
                new.append(w)
        joined = " " + " ".join(new)
        if not new or any(token in joined for token in self.added):
            self.words.update((w, self.piece(" " + w)) for w in new)
            return
        raw = self.whole(joined)
        starts = np.flatnonzero(self.opens[np.frombuffer(raw, "<u4")]) * ID_BYTES
        if len(starts) != len(new):
            self.words.update((w, self.piece(" " + w)) for w in new)
            return
        ends = [*starts[1:].tolist(), len(raw)]
        self.words.update((w, raw[i:j]) for w, i, j in zip(new, starts.tolist(), ends))

    def encode(self, text: str) -> bytes:
        if not self.by_piece or any(token in text for token in self.added):
            return self.whole(text)
        if len(self.words) >= self.limit:
            self.old, self.words = self.words, {}
        first, *words = text.split(" ")
        missing = set(words).difference(self.words)
        if any(not w or w[0].isspace() for w in missing):  # such a blank starts no piece
            first, *words = PIECE_START.split(text)
            words = [w[1:] for w in words]
            missing = set(words).difference(self.words)
        if missing:
            self.learn(list(missing))
        ids = self.piece(first) + b"".join(map(self.words.__getitem__, words))
        for w in missing:
            if len(w) > KEPT:
                del self.words[w]
        return ids

    def encode_many(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        """The ids of each text in turn, as ``encode`` gives them (None: empty), many words at a time."""
        waiting, size = [], 0  # per text the ids of its first piece, and portions that begin with a blank
        for text in texts:
            text = text or ""
            if not self.by_piece or any(sign in text for sign in ("\x00", MARK, *self.added)):
                yield from self.portions(waiting)
                waiting, size = [], 0
                yield np.frombuffer(self.encode(text), "<u4")
                continue
            if INNER_BLANK.search(text):
                text = INNER_BLANK.sub(MARK, text)
            at = text.find(" ") if " " in text else len(text)
            head, parts = text[:at], []
            while at < len(text):
                end = len(text)
                if end - at > PORTION:
                    end = text.rfind(" ", at + 1, at + PORTION)
                    end = end if end > 0 else text.find(" ", at + PORTION)
                    end = end if end > 0 else len(text)
                parts.append(text[at:end])
                size, at = size + end - at, end
            if max(map(len, parts), default=0) > 8 * PORTION:  # a word that no count of a slot holds
                yield from self.portions(waiting)
                waiting, size = [], 0
                yield np.frombuffer(self.encode(text.replace(MARK, " ")), "<u4")
                continue
            waiting.append((self.piece(head.replace(MARK, " ")), parts))
            if size >= PORTION:
                yield from self.portions(waiting)
                waiting, size = [], 0
        yield from self.portions(waiting)

    def portions(self, waiting: list[tuple[bytes, list[str]]]) -> Iterator[np.ndarray]:
        """Ids of texts; small ones are looked up together, a long one portion by portion."""
        if not waiting:
            return
        if len(waiting) > 1 and max(len(parts) for _, parts in waiting) > 1:
            for one in waiting:
                yield from self.portions([one])
            return
        if len(waiting) == 1:
            head, parts = waiting[0]
            found = [ids for part in parts for ids in self.look_up([part])]
            yield np.concatenate([np.frombuffer(head, "<u4"), *found])
            return
        found = self.look_up(["".join(parts) for _, parts in waiting])
        for (head, _), ids in zip(waiting, found):
            yield np.concatenate([np.frombuffer(head, "<u4"), ids])

    def look_up(self, parts: list[str]) -> list[np.ndarray]:
        """Ids of texts that are empty or begin with a blank."""
        table = self.table
        raw = "".join(parts).encode()
        data = np.frombuffer(raw + bytes(table.LETTERS + 8), np.uint8)
        starts = np.flatnonzero(data[: len(raw)] == 32) + 1
        sizes = np.diff(starts, append=len(raw) + 1) - 1
        table.make_room(len(starts))
        keys = table.keys(data, starts, sizes)
        values = table.find(keys)
        short = sizes <= table.LETTERS
        values[~short] = 0
        missing = np.flatnonzero(values == 0)
        before = table.used
        if len(missing):
            spans = zip(starts[missing].tolist(), (starts + sizes)[missing].tolist())
            number: dict[bytes, int] = {}
            which = np.array([number.setdefault(raw[i:j], len(number)) for i, j in spans])
            ids, places, counts = self.fresh(list(number))
            places += table.append(ids)
            fresh = (places.astype(np.uint64) << np.uint64(24)) + counts.astype(np.uint64)
            values[missing] = fresh[which]
        counts = (values & np.uint64((1 << 24) - 1)).astype(np.int64)
        ends = np.cumsum(counts)
        index = np.repeat((values >> np.uint64(24)).astype(np.int64) - ends + counts, counts)
        index += np.arange(len(index))
        out = table.ids[index]
        if len(missing):
            first = np.full(len(number), -1)
            first[which[::-1]] = missing[::-1]
            keep = short[first]
            if keep.all():
                table.add(keys[first], fresh)
            else:  # the ids of long words make room again
                table.used = before
                lengths = counts[first][keep]
                again = np.repeat(places[keep] - np.cumsum(lengths) + lengths, lengths)
                kept = table.ids[again + np.arange(len(again))]
                base = table.append(kept)
                places = base + np.cumsum(lengths) - lengths
                fresh = (places.astype(np.uint64) << np.uint64(24)) + lengths.astype(np.uint64)
                table.add(keys[first][keep], fresh)
        words = np.cumsum([part.count(" ") for part in parts])
        bounds = np.concatenate([[0], ends])[words]
        return np.split(out, bounds[:-1])

    def fresh(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the pieces that a blank and each word make; where each begins, and how many it has.

        Letters, perhaps with a few signs behind them, go to the model at once. The other
        words go through the library in one text: in its ids, just the first of each
        piece is of a token that begins with a blank.
        """
        raw = b" " + b" ".join(words)
        joined = raw.decode()
        counts, starts = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        if any(token in joined for token in self.added):
            each = [np.frombuffer(self.piece(" " + w.decode().replace(MARK, " ")), "<u4") for w in words]
            counts[:] = [len(x) for x in each]
            return np.concatenate(each), np.cumsum(counts) - counts, counts
        forms = raw.decode("latin-1").translate(self.letters).split(BLANK)[1:]
        flat, rest, spans = [], [], []
        tokenize, match, signs = self.model.tokenize, LETTERS.match, SIGNS.fullmatch
        for i, (word, form) in enumerate(zip(joined.split(" ")[1:], forms)):
            found = match(word)
            tail = word[found.end() :] if found else word
            if not found or tail and not signs(tail):
                rest.append(i)
                spans.append(0)
                continue
            before = len(flat)
            flat += [t.id for t in tokenize(BLANK + form[: len(form) - len(tail)])]
            if tail:
                flat += array("I", self.rest(tail))
            spans.append(len(flat) - before)
        counts[:] = spans
        starts[:] = np.cumsum(counts) - counts
        found, length = [np.array(flat, "<u4")], len(flat)
        plain = [i for i in rest if MARK.encode() not in words[i]]
        if plain:
            other = np.frombuffer(self.whole(" " + " ".join([words[i].decode() for i in plain])), "<u4")
            first = np.flatnonzero(self.opens[other])
            if len(first) != len(plain):
                each = [np.frombuffer(self.piece(" " + words[i].decode()), "<u4") for i in plain]
                other, first = np.concatenate(each), np.cumsum([0, *map(len, each)])[:-1]
            starts[plain] = first + length
            counts[plain] = np.diff(first, append=len(other))
            found.append(other)
            length += len(other)
        for i in rest:
            if MARK.encode() in words[i]:
                one = np.frombuffer(self.whole(" " + words[i].decode().replace(MARK, " ")), "<u4")
                starts[i], counts[i] = length, len(one)
                found.append(one)
                length += len(one)
        ids = np.concatenate(found)
        return ids, starts, counts


ENCODERS: dict[str, TextEncoder] = {}


def encoder(path: str) -> TextEncoder:
    """One encoder per file and worker process."""
    if path not in ENCODERS:
        ENCODERS[path] = TextEncoder(path)
    return ENCODERS[path]
