"""Tokenizer libraries inside Arrow tasks.

The libraries of this module encode a few MB a second and core, and most of
that goes into words that have been seen before.  All three vocabularies
handled here treat a text as a sequence of stretches that start at a single
space and never influence each other, so a text is split at those safe places,
distinct stretches are encoded once per Python worker in batches, and the ids
of a text are gathered from the results:

* byte-level BPE: the splitting pattern keeps a space with what follows it, and
  its only look-ahead concerns runs of white space;
* word BPE that drops white space: any space ends a word;
* sentencepiece with the identity normaliser: a space becomes the word mark,
  which begins pieces and never occurs inside one.

Stretches that begin or end with white space (runs of spaces, a space beside a
line break, two line breaks) are not safe; their texts are cut only at single spaces between
two other characters and encoded without the memo.  A tokenizer whose files
don't show one of these forms gets whole texts.

Where words seldom come twice, most of the time goes into new stretches.  In the
two BPE forms, ASCII marks after plain letters are a word of their own and are
taken off before the memo is asked, so a word is learnt once, whatever follows
it.  A stretch that is plain letters or marks is one word and goes to the
library's model of the file, in its byte alphabet, without the normaliser and
splitting pattern before it.
"""

from __future__ import annotations

import codecs
import json
import os
import re
from itertools import chain, islice, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from plantwise.llm.common import ranges

#: Distinct stretches after which a worker's memo starts anew (about 200 bytes each); what is
#: used again is taken over from the one before, so two of them are kept.
MEMO_PIECES = 500_000
#: Of them, those that :meth:`Encoder.forget` keeps.
KEPT_PIECES = 50_000
#: Texts with longer stretches are encoded without the memo, so its size is bounded in bytes too.
MEMO_CHARS = 200
#: Stretches sent to the library in one call.
CALL_PIECES = 20_000
#: Bytes of text encoded at a time: of more text, a larger share of the stretches comes twice.
STEP_BYTES = 4 << 20

_BETWEEN = re.compile(r"(?<=\S) (?=\S)")


#: Marks a stretch that no space precedes; texts that contain it go the plain way.
_MARK = "\x01"
#: In place of the slot of a stretch that the memo lacks.
_NEW = -2
#: Slot of no ids: that of a stretch that can't stand alone.
_NONE = -1

#: Letters that every Unicode version lower-cases alike and that compose with nothing, and
#: ASCII marks but for the apostrophe, which may begin a contraction.
_LETTERS = [chr(c) for c in (*range(65, 91), *range(97, 123), *range(0xC0, 0x100)) if chr(c).isalpha()]
_MARKS = [chr(c) for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'"]
#: Cuts words; a byte that no plain word holds.
_CUT = "\x02"
#: The pattern of the word BPE whose words :class:`_Words` can tell.
_WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _byte_alphabet() -> str:
    """The character that byte-level BPE writes for each byte; a space for the cut."""
    own = [*range(33, 127), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in own)}
    return "".join(" " if b == ord(_CUT) else out[b] for b in range(256))


class _Words:
    """Ids of plain words, which are runs of letters or of marks with the space
    before them, by a tokenizer's model."""

    def __init__(self, tok, added: list[str], lead: bool, lower: bool):
        first = {t[0].lower() for t in added}  # what begins a special string isn't plain
        letters, marks = ("".join(map(re.escape, (c for c in chars if c.lower() not in first))) for chars in (_LETTERS, _MARKS))
        mark = f"{_MARK}?" if lead else ""
        #: A plain word; one of letters and the one of marks after it.
        self.plain = f"^{mark}(?:[{letters}]+|[{marks}]+)$"
        self.ended = f"^(?P<rest>{mark}[{letters}]+)(?P<tail>[{marks}]+)$"
        self.lead, self.lower, self.alphabet = lead, lower, _byte_alphabet()
        self.tokenize = tok.model.tokenize

    def split(self, keys: pa.Array) -> tuple[pa.Array, np.ndarray, pa.Array]:
        """(stretches without the marks at their end, places of those that had some, the marks)."""
        parts = pc.extract_regex(keys, self.ended)
        ended = pc.and_(pc.is_valid(parts), self._short(keys))
        rest, tail = pc.struct_field(parts, "rest"), pc.struct_field(parts, "tail").filter(ended)
        if self.lead:
            mark, none = (pa.scalar(x, pa.large_string()) for x in (_MARK, ""))
            tail = pc.binary_join_element_wise(mark, tail, none)
        return pc.if_else(ended, rest, keys), np.flatnonzero(ended.to_numpy(zero_copy_only=False)), tail

    def are_plain(self, keys: pa.Array) -> np.ndarray:
        return pc.and_(pc.match_substring_regex(keys, self.plain), self._short(keys)).to_numpy(zero_copy_only=False)

    @staticmethod
    def _short(keys: pa.Array) -> pa.Array:
        return pc.less_equal(pc.utf8_length(keys), MEMO_CHARS // 2)

    def ids(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all, ids of each) of plain stretches."""
        text = " " + f"{_CUT} ".join(keys) if self.lead else _CUT.join(keys)
        if self.lead:
            text = text.replace(f" {_MARK}", "")
        signs = codecs.charmap_decode((text.lower() if self.lower else text).encode(), "strict", self.alphabet)[0]
        tokens = list(map(self.tokenize, signs.split(" ")))
        return (np.array([t.id for word in tokens for t in word], np.uint32),
                np.fromiter(map(len, tokens), np.int64, len(tokens)))


class Encoder:
    """Ids of whole texts by the ``tokenizers`` library (``.json``) or
    ``sentencepiece`` (``.model``): no added special tokens, no truncation, no
    padding; special strings inside a text as the library treats them."""

    def __init__(self, path: str):
        self.lead, self.blank, self.unsafe, self.words = False, False, None, None
        if path.endswith(".model"):
            import sentencepiece

            sp = sentencepiece.SentencePieceProcessor(model_file=path)
            self.call = lambda texts: sp.encode(texts, num_threads=1)
            pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
            if not any("\u2581" in p.lstrip("\u2581") for p in pieces):
                self.unsafe = lambda p: not p or p[0].isspace() or p[-1].isspace() or "\u2581" in p
        else:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on each core already
            from tokenizers import Tokenizer

            tok = Tokenizer.from_file(path)
            tok.no_truncation()
            tok.no_padding()
            self.call = lambda texts: [e.ids for e in tok.encode_batch_fast(texts, add_special_tokens=False)]
            with open(path, encoding="utf-8") as f:
                spec = json.load(f)
            pre = spec.get("pre_tokenizer") or {}
            added = [t["content"] for t in spec.get("added_tokens") or []]
            if not any(t.get("lstrip") or t.get("rstrip") or re.search(r"\s", t["content"]) for t in spec.get("added_tokens") or []):
                if spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space"):
                    self.lead, self.unsafe = True, self._cannot_stand
                    self.words = _Words(tok, added, True, False)
                elif pre.get("type") == "Sequence" and pre["pretokenizers"][0].get("invert") and "\\s" in json.dumps(pre["pretokenizers"][0]):
                    self.blank, self.unsafe = True, lambda p: False
                    steps = (spec.get("normalizer") or {}).get("normalizers") or []
                    split, last = pre["pretokenizers"][0], pre["pretokenizers"][1:]
                    if ([x["type"] for x in steps] == ["NFC", "Replace", "Lowercase"] and split.get("pattern") == {"Regex": _WORD_PATTERN}
                            and [(x["type"], x.get("use_regex"), x.get("add_prefix_space")) for x in last] == [("ByteLevel", False, False)]):
                        self.words = _Words(tok, added, False, True)
        self.memo = {}
        self._reset()
        if self.words and not self._agrees():
            self.words, self.memo = None, {}
            self._reset()
        if self.unsafe and not self._agrees():
            self.unsafe = None

    @staticmethod
    def _cannot_stand(p: str) -> bool:
        if p == "\n":
            return False
        p = p.removeprefix(_MARK)
        return not p or p[0].isspace() or p[-1].isspace() or _MARK in p

    def _cut(self, texts: list[str]) -> tuple[pa.Array, np.ndarray]:
        """(stretches of each text, texts that can't be cut)."""
        col = pa.array(texts, pa.large_string())
        odd = np.zeros(len(texts), bool)
        if self.lead:  # a line break between two other characters is a stretch of its own
            odd = pc.match_substring(col, _MARK).to_numpy(zero_copy_only=False)
            mark, none = (pa.scalar(x, pa.large_string()) for x in (_MARK, ""))
            col = pc.binary_join_element_wise(mark, pc.replace_substring(col, "\n", f" \n {_MARK}"), none)
        elif self.blank:
            col = pc.replace_substring(col, "\n", " ")
        return pc.split_pattern(col, " "), odd

    def _reset(self):
        """Start a new memo, stretch -> slot, and keep the one before."""
        self.before = self.memo
        if self.before:
            self.old = self.start, self.size, self.pool[:self.used]
        self.memo = {}
        self.start, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool, self.used = np.zeros(1 << 16, np.uint32), 0

    def forget(self):
        """Keep only the first ``KEPT_PIECES`` stretches of the memo, which come
        often, and hand the rest back to the system: a worker lives on after its
        task, while other stages need the executor's memory."""
        self.before, self.old = {}, None
        self.memo = dict(islice(self.memo.items(), KEPT_PIECES))
        n = len(self.memo)
        self.start, self.size = self.start[:n].copy(), self.size[:n].copy()
        self.used = int(self.size.sum())
        self.pool = self.pool[:self.used].copy()
        pa.default_memory_pool().release_unused()

    def _agrees(self) -> bool:
        probe = ["A b's c.\nD  e", "x\n y", " a", "a ", "", "  ", "na\u00efve \u4e2d\u6587 1234!? \t z", "a \u0301b \ufb01x", "a \u2581 b",
                 "Plain \u00c4\u00f6\u00df, (a-b) x... <|endoftext|> ((c d)) \u00d7 \u00aa's l'\u00e9t\u00e9 e.g. #1"]
        return [x.tolist() for x in self.encode(probe)] == [list(x) for x in self.call(probe)]

    def _known(self, stretches: pa.Array) -> np.ndarray:
        """Slot of each stretch; those that the memo lacks are learnt."""
        coded = stretches.dictionary_encode()  # each distinct one is looked up once
        keys = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        own = np.fromiter(map(self.memo.get, keys, repeat(_NEW)), np.int64, len(keys))
        new = np.flatnonzero(own == _NEW)
        if len(new):
            own[new] = self._learn([keys[i] for i in new.tolist()])
        return own[coded.indices.to_numpy()]

    def _learn(self, keys: list[str]) -> np.ndarray:
        """Slots of stretches that the memo lacks, ``_NONE`` for one that can't stand alone."""
        slots = np.full(len(keys), _NONE)
        found = []  # (places in keys, ids of all, ids of each)
        fresh = np.arange(len(keys))
        if self.before:
            old = np.fromiter(map(self.before.get, keys, repeat(_NONE)), np.int64, len(keys))
            again, fresh = np.flatnonzero(old != _NONE), np.flatnonzero(old == _NONE)
            start, size, pool = self.old
            old = old[again]
            found.append((again, pool[ranges(start[old], size[old])], size[old]))
        plain = np.zeros(len(fresh), bool)
        if self.words and len(fresh):
            plain = self.words.are_plain(pa.array([keys[i] for i in fresh.tolist()], pa.large_string()))
        other = [i for i in fresh[~plain].tolist() if len(keys[i]) <= MEMO_CHARS and not self.unsafe(keys[i])]
        for some, call in ((fresh[plain].tolist(), self.words and self.words.ids), (other, self._by_library)):
            for k in range(0, len(some), CALL_PIECES):
                here = some[k:k + CALL_PIECES]
                found.append((np.array(here), *call([keys[i] for i in here])))
        if found:
            self._keep(keys, slots, *(np.concatenate(x) for x in zip(*found)))
        return slots

    def _keep(self, keys: list[str], slots: np.ndarray, at: np.ndarray, ids: np.ndarray, sizes: np.ndarray):
        if self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(max(len(self.pool), len(ids)), np.uint32)])
        self.pool[self.used:self.used + len(ids)] = ids
        slots[at] = len(self.memo) + np.arange(len(at))
        self.memo.update(zip(map(keys.__getitem__, at.tolist()), slots[at].tolist()))
        self.start = np.concatenate([self.start, self.used + np.cumsum(sizes) - sizes])
        self.size = np.concatenate([self.size, sizes])
        self.used += len(ids)

    def _by_library(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if self.lead:
            keys = [x if x == "\n" else x[1:] if x[:1] == _MARK else f" {x}" for x in keys]
        parts = self.call(keys)
        return np.fromiter(chain.from_iterable(parts), np.uint32), np.fromiter(map(len, parts), np.int64, len(parts))

    def _slots(self, texts):
        """Two slots of each distinct stretch (the second of the marks at its
        end), all texts' stretches as places among those, stretches per text, and
        the texts that have to go to the library as they are."""
        if len(self.memo) > MEMO_PIECES:
            self._reset()
        if not texts:
            return np.zeros((0, 2), np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        parts, uncut = self._cut(texts)
        count = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
        words = parts.flatten().dictionary_encode()
        keys, at = words.dictionary, words.indices.to_numpy()
        slots = np.full((len(keys), 2), _NONE)
        if self.words:
            keys, ended, tails = self.words.split(keys)
            slots[ended, 1] = self._known(tails)
        slots[:, 0] = self._known(keys)
        alone = slots[:, 0] != _NONE
        odd = np.flatnonzero(~np.logical_and.reduceat(alone[at], np.cumsum(count) - count) | uncut)
        return slots, at, count, odd

    def _sizes(self, slots: np.ndarray) -> np.ndarray:
        """Ids of each distinct stretch."""
        known, size = slots != _NONE, np.zeros(slots.shape, np.int64)
        size[known] = self.size[slots[known]]
        return size.sum(axis=1)

    def _plainly(self, text) -> np.ndarray:
        if self.unsafe is None:
            return np.array(self.call([text])[0], dtype=np.uint32)
        if "\u2581" in text:
            pieces = [text]
        else:
            pieces = _BETWEEN.split(text)
            if self.lead:
                pieces[1:] = [f" {p}" for p in pieces[1:]]
        return np.fromiter(chain.from_iterable(self.call(pieces)), dtype=np.uint32)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if self.unsafe is None:
            return [np.array(x, dtype=np.uint32) for x in self.call(texts)]
        slots, at, count, odd = self._slots(texts)
        known, size = slots[slots != _NONE], self._sizes(slots)
        pool = self.pool[ranges(self.start[known], self.size[known])]  # of the distinct stretches
        start, size = (np.cumsum(size) - size)[at], size[at]
        ids = pool[ranges(start, size)]
        ends = np.cumsum(size)[np.cumsum(count) - 1] if len(texts) else []
        out, a = [], 0
        for b in ends:
            out.append(ids[a:b])
            a = b
        for k in odd:
            out[k] = self._plainly(texts[k])
        return out

    def count(self, texts: list[str]) -> np.ndarray:
        """Numbers of ids only."""
        if self.unsafe is None:
            return np.array([len(x) for x in self.call(texts)], dtype=np.int64)
        slots, at, count, odd = self._slots(texts)
        size = self._sizes(slots)[at]
        out = np.add.reduceat(size, np.cumsum(count) - count) if len(texts) else np.zeros(0, np.int64)
        for k in odd:
            out[k] = len(self._plainly(texts[k]))
        return out


_KEPT: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder of a file, loaded once; one at a time is kept."""
    if path not in _KEPT:
        _KEPT.clear()
        _KEPT[path] = Encoder(path)
    return _KEPT[path]


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)
