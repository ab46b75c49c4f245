"""BPE by dynamic programming over prefixes, for vocabularies that others trained.

Every prefix of a word has one last token in its encoding. Of the vocabulary
strings that end at a position (an Aho-Corasick automaton, the suffix automaton
of the vocabulary, gives them all) it is the one that BPE would keep apart from
the last token before it. That is a test on two tokens alone: unmerge what
touches the border, latest merge first, and see whether the two neighbours would
have been merged earlier. So one pass gives the last token and the number of
tokens of every prefix, and following the back-pointers gives the ids.
"""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Iterable
from functools import cache

import ahocorasick
import numpy as np

from .words import Remembered

_NEVER = 1 << 60

# What a worker remembers; each is forgotten when full, which costs time only. An entry
# takes 100 to 200 bytes, so all of them together stay below 150 MB.
_REMEMBERED_PAIRS = 1 << 18
_REMEMBERED_PIECES = 1 << 19
_REMEMBERED_WORDS = 1 << 17
_REMEMBERED_PREFIXES = 1 << 19


# Settings under which letters of Latin-1, lower-cased, are one word, and ASCII marks behind them another.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_LETTERS_THEN_MARKS = re.compile(rf"([{_LETTERS}]+)([!-/:-@\[-`{{-~]*)")
_KNOWN_NORMALIZER = {
    "type": "Sequence",
    "normalizers": [
        {"type": "NFC"},
        {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
        {"type": "Lowercase"},
    ],
}
_KNOWN_WORDS = {
    "type": "Sequence",
    "pretokenizers": [
        {
            "type": "Split",
            "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
            "behavior": "Removed",
            "invert": True,
        },
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}


def id_bytes(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    return struct.pack(f"<{len(ids)}I", *ids)


class PrefixBpe:
    """BPE over strings whose symbols are single characters.

    ``tokens`` maps each string to its rank (symbols: -1): of all pairs that
    could be merged BPE takes the one of least rank, leftmost first. ``pairs``
    says what a pair merges into, or None: by default, the two put together if
    that is a token.
    """

    def __init__(
        self,
        tokens: dict[str, int],
        pairs: dict[tuple[str, str], str] | None = None,
    ):
        self.rank = tokens
        self._pairs = pairs
        self._names = list(tokens)
        self._automaton = ahocorasick.Automaton()
        for number, token in enumerate(self._names):
            self._automaton.add_word(token, (number, len(token)))
        self._automaton.make_automaton()
        self._halves: dict[str, tuple[str, str] | None] = {}
        # Which tokens can follow which, by number; -1 is the beginning of a word.
        self._follows: dict[int, bool] = {}

    def merged(self, left: str, right: str) -> str | None:
        if self._pairs is not None:
            return self._pairs.get((left, right))
        both = left + right
        return both if both in self.rank else None

    def halves(self, token: str) -> tuple[str, str] | None:
        """What BPE merges last to get ``token``; None if it never gets there."""
        if token not in self._halves:
            parts, last = list(token), None
            while len(parts) > 1:
                options = [
                    (self.rank[joined], i, joined)
                    for i in range(len(parts) - 1)
                    if (joined := self.merged(parts[i], parts[i + 1])) is not None
                ]
                if not options:
                    break
                _, i, joined = min(options)
                last = (parts[i], parts[i + 1])
                parts[i : i + 2] = [joined]
            self._halves[token] = last if parts == [token] else None
        return self._halves[token]

    def whole(self, token: str) -> bool:
        """Whether BPE encodes the token's own string as this token."""
        return len(token) == 1 or self.halves(token) is not None

    def apart(self, left: str, right: str) -> bool:
        """Whether BPE leaves ``left`` and ``right`` as they are, side by side."""
        return self.whole(left) and self.whole(right) and self._stay_apart(left, right)

    def _follow(self, before: int, token: int) -> bool:
        """Whether ``token`` comes after ``before``, the last token of what is before it."""
        right = self._names[token]
        known = self.whole(right) and (
            before < 0 or self._stay_apart(self._names[before], right)
        )
        if len(self._follows) >= _REMEMBERED_PAIRS:
            self._follows.clear()
        self._follows[before * len(self._names) + token] = known
        return known

    def _stay_apart(self, left: str, right: str) -> bool:
        # Going back in time, `left` and `right` touch the border and are both there
        # until a merge of rank `until` takes one of them away.
        until = _NEVER
        while True:
            joined = self.merged(left, right)
            if joined is not None and self.rank[joined] < until:
                return False
            here, there = self.rank[left], self.rank[right]
            if here < 0 and there < 0:
                return True
            if here > there:
                # The merge inside `left` is further left, so it wins a draw.
                until, left = here, self.halves(left)[1]
            else:
                until, right = there + 1, self.halves(right)[0]

    def _last_tokens(self, word: str) -> list[int]:
        """Number of the last token of each prefix, by its last character; -1 behind all, of the empty one."""
        last = [-2] * len(word) + [-1]
        follows, size = self._follows, len(self._names)
        for end, (token, length) in self._automaton.iter(word):
            if last[end] == -2:
                before = last[end - length]
                known = follows.get(before * size + token)
                if self._follow(before, token) if known is None else known:
                    last[end] = token
        return last

    def prefixes(self, word: str) -> list[int]:
        """Number of tokens of each prefix, by its length; every character has to be a symbol."""
        counts = [0]
        for end, token in enumerate(self._last_tokens(word)[:-1], 1):
            counts.append(counts[end - len(self._names[token])] + 1)
        return counts

    def encode(self, word: str) -> list[str]:
        last, names = self._last_tokens(word), self._names
        out, end = [], len(word)
        while end:
            token = names[last[end - 1]]
            out.append(token)
            end -= len(token)
        return out[::-1]

    def count(self, word: str) -> int:
        """Number of tokens of a word."""
        last, names = self._last_tokens(word), self._names
        n, end = 0, len(word)
        while end:
            n, end = n + 1, end - len(names[last[end - 1]])
        return n


class WordEndTokenizer:
    """Encoder for a ``tokenizers`` file of byte-level BPE with word ends.

    Normalising and cutting into words is left to the file's own settings; the
    words are encoded here. White space between ASCII words never matters to
    either, so a text is cut there first and each distinct piece handled once.
    Under the settings known above, pieces of Latin letters and marks behind them
    need no call of the library: it says once what each letter becomes.
    Strings of added tokens inside a text become these tokens, as the library
    has it.
    """

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            settings = json.load(file)
        model = settings["model"]
        self._end = model["end_of_word_suffix"]
        self.ids: dict[str, int] = dict(model["vocab"])
        added = {x["content"]: x["id"] for x in settings["added_tokens"]}
        if any(x["normalized"] or x["lstrip"] or x["rstrip"] or x["single_word"]
               for x in settings["added_tokens"]):
            raise ValueError("only added tokens that match their plain string are known")
        self.ids |= added
        self.strings = {i: s for s, i in self.ids.items()}
        self._added = [s.encode() for s in added]
        longest_first = sorted(self._added, key=len, reverse=True)
        self._cut = regex.compile(b"(" + b"|".join(map(regex.escape, longest_first)) + b")")

        merges = [
            tuple(x.split(" ")) if isinstance(x, str) else tuple(x) for x in model["merges"]
        ]
        # A symbol at the end of a word is another symbol: give it a character of its own.
        symbols = [s for s in model["vocab"] if len(s.removesuffix(self._end)) == 1]
        ended = sorted(s for s in symbols if s.endswith(self._end))
        self._ended = {s[0]: chr(0xE000 + i) for i, s in enumerate(ended)}
        self._plain = {c: s for s, c in self._ended.items()}
        tokens = {self._packed(s): -1 for s in symbols}
        pairs = {}
        for i, (left, right) in enumerate(merges):
            joined = self._packed(left + right)
            tokens[joined] = i
            pairs[self._packed(left), self._packed(right)] = joined
        self._bpe = PrefixBpe(tokens, pairs)
        self._id_of = {t: self.ids[self._unpacked(t)] for t in tokens}
        library = Tokenizer.from_file(path)
        self._normalizer, self._words = library.normalizer, library.pre_tokenizer
        self._letters: dict[int, str] | None = None
        if settings["normalizer"] == _KNOWN_NORMALIZER and settings["pre_tokenizer"] == _KNOWN_WORDS:
            letters = filter(re.compile(f"[{_LETTERS}]").match, map(chr, range(256)))
            self._letters = {ord(c): "".join(self._cut_words(c)) for c in letters}
        self._piece_ids = Remembered(self._encode_piece, _REMEMBERED_PIECES)
        self._word_ids = Remembered(self._encode_word, _REMEMBERED_WORDS)

    def _packed(self, string: str) -> str:
        if string.endswith(self._end):
            string = string.removesuffix(self._end)
            return string[:-1] + self._ended[string[-1]]
        return string

    def _unpacked(self, token: str) -> str:
        return token[:-1] + self._plain[token[-1]] + self._end if token[-1] in self._plain else token

    def _encode_word(self, word: str) -> bytes:
        return id_bytes([self._id_of[t] for t in self._bpe.encode(self._packed(word + self._end))])

    def _cut_words(self, piece: str) -> list[str]:
        """The words of a piece, as the file's settings give them."""
        text = self._normalizer.normalize_str(piece)
        return [word for word, _ in self._words.pre_tokenize_str(text)]

    def _encode_piece(self, piece: bytes) -> bytes:
        text, ids_of = piece.decode("utf-8"), self._word_ids
        if self._letters is not None and (found := _LETTERS_THEN_MARKS.fullmatch(text)):
            word, marks = found.groups()
            ids = ids_of[word.translate(self._letters)]
            return ids + ids_of[marks] if marks else ids
        return b"".join([ids_of[word] for word in self._cut_words(text)])

    def encode_bytes(self, data: bytes | None) -> bytes:
        """Ids of a text given as UTF-8, as ``id_bytes``; none for NULL or an empty text."""
        ids_of, parts = self._piece_ids, self._cut.split(data or b"")
        if len(parts) == 1:
            return b"".join([ids_of[piece] for piece in parts[0].split()])
        return b"".join(
            id_bytes([self.ids[part.decode()]])
            if part in self._added
            else b"".join([ids_of[piece] for piece in part.split()])
            for part in parts
        )

    def encode(self, data: bytes | None) -> list[int]:
        """Ids of a text given as UTF-8; none for NULL or an empty text."""
        return np.frombuffer(self.encode_bytes(data), "<u4").tolist()

    def decode(self, ids: Iterable[int]) -> str:
        """The tokens with a space between them, as a file without a decoder has it."""
        return " ".join(map(self.strings.__getitem__, ids))


class PieceTokenizer:
    """Token counts of a ``sentencepiece`` BPE model, by prefix.

    Takes models that leave characters alone, put a space before the text and
    write a space as U+2581. Such a mark begins a piece, so a text falls into
    words with a mark before each; only runs of marks are left, which are pieces
    of lowest rank. Characters that are not in the model are their bytes.
    """

    MARK = "▁"

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        mark = self.MARK
        tokens, self._runs = {}, set()
        for i in range(model.get_piece_size()):
            if model.is_control(i) or model.is_unknown(i) or model.is_byte(i):
                continue
            piece = model.id_to_piece(i)
            if set(piece) == {mark}:
                self._runs.add(len(piece))
                if len(piece) > 1:
                    continue
            elif mark in piece[1:] or "\n" in piece:
                raise ValueError(f"a mark or line end inside a piece: {piece!r}")
            tokens[piece] = -1 if len(piece) == 1 else -int(model.get_score(i))
        if model.encode("a b ", out_type=str) != [mark + "a", mark + "b", mark]:
            raise ValueError("the model changes spaces")
        self._bpe = PrefixBpe(tokens)
        self._symbols = {t for t in tokens if len(t) == 1}
        # Tokens of every prefix of a word, after a mark and without one, and whether the
        # mark stays alone.
        self._marked = Remembered(lambda word: self._stored(self.MARK + word), _REMEMBERED_PREFIXES)
        self._bare = Remembered(self._stored, _REMEMBERED_PREFIXES)
        self._alone = Remembered(self._mark_alone, _REMEMBERED_PREFIXES)
        self._run_counts = [0]
        self._run_parts: list[int] = []

    def _word_prefixes(self, word: str) -> list[int]:
        """Tokens of each prefix, by its length in characters."""
        counts, base, start = [0], 0, 0
        for i, c in enumerate([*word, None]):
            if c is None or c not in self._symbols:
                if i > start:
                    counts += [base + n for n in self._bpe.prefixes(word[start:i])[1:]]
                    base = counts[-1]
                if c is not None:
                    base += len(c.encode("utf-8"))
                    counts.append(base)
                start = i + 1
        return counts

    def _stored(self, word: str) -> bytes | list[int]:
        """``_word_prefixes``, packed where the counts fit bytes."""
        if self._symbols.issuperset(word):
            counts = self._bpe.prefixes(word)
        else:
            counts = self._word_prefixes(word)
        return bytes(counts) if len(word) < 64 and counts[-1] < 256 and max(counts) < 256 else counts

    def _mark_alone(self, word: str) -> bool:
        """Whether the first token of the marked word is the mark alone."""
        if word[:1] not in self._symbols:
            return True
        end = next((i for i, c in enumerate(word) if c not in self._symbols), len(word))
        return self._bpe.encode(self.MARK + word[:end])[0] == self.MARK

    def run_count(self, length: int) -> int:
        """Tokens of a run of marks; pairs merge leftmost first while the sum is a piece."""
        while len(self._run_counts) <= length:
            parts = self._run_parts
            parts.append(1)
            while len(parts) > 1 and parts[-2] + parts[-1] in self._runs:
                parts[-2:] = [parts[-2] + parts[-1]]
            self._run_counts.append(len(parts))
        return self._run_counts[length]

    def measure(self, data: bytes | None, budget: int) -> tuple[int, int]:
        """Tokens of a text given as UTF-8, and characters of its longest prefix of ``budget`` tokens.

        Both come from the stored counts of the prefixes of its words: the total
        from their last entries, and the cut from those of the word in which the
        total goes over the budget. An empty text and NULL have 0 of both.
        """
        if not data:
            return 0, 0
        plain = data.decode("utf-8")
        text = self.MARK + plain.replace(" ", self.MARK)
        total, at, marked, bare = 0, 0, self._marked, self._bare
        # Where the first unit begins that goes over the budget, and the tokens before.
        over: tuple[int, int, int] | None = None
        for number, line in enumerate(text.split("\n")):
            if number:
                if over is None and total + 1 > budget:
                    over = at, at + 1, total
                total += 1
                at += 1
            first, *words = line.split(self.MARK)
            if first:
                own = bare[first][-1]
                if over is None and total + own > budget:
                    over = at, at + len(first), total
                total += own
                at += len(first)
            waiting = 0  # marks before the next word, without its own
            for word in words:
                if not word:
                    waiting += 1
                    continue
                own = marked[word][-1]
                if waiting:
                    # A mark that stays alone is one more of the run.
                    own += self.run_count(waiting + 1) - 1 if self._alone[word] else self.run_count(waiting)
                end = at + waiting + 1 + len(word)
                if over is None and total + own > budget:
                    over = at, end, total
                total += own
                at, waiting = end, 0
            own = self.run_count(waiting)
            if over is None and total + own > budget:
                over = at, at + waiting, total
            total += own
            at += waiting
        if over is None:
            return total, len(plain)
        # The text has a mark before its first character.
        begin, end, before = over
        inside = [before + n for n in self._unit_prefixes(text[begin:end])]
        return total, max(max((i for i, n in enumerate(inside) if n <= max(budget, 0)), default=0) + begin - 1, 0)

    def _unit_prefixes(self, unit: str) -> list[int]:
        """Tokens of each prefix of a line end, or of marks and a word."""
        word = unit.lstrip(self.MARK)
        marks = len(unit) - len(word)
        counts = [self.run_count(i) for i in range(marks + 1)]
        if unit == "\n":
            return [0, 1]
        stored = self._marked[word] if marks else self._bare[word]
        for k in range(1, len(word) + 1):
            if not marks:
                counts.append(stored[k])
            elif self._mark_alone(word[:k]):
                counts.append(stored[k + 1] + self.run_count(marks) - 1)
            else:
                counts.append(stored[k + 1] + self.run_count(marks - 1))
        return counts

    def count(self, data: bytes | None) -> int:
        """Tokens of a text given as UTF-8; 0 for NULL or an empty text."""
        return self.measure(data, len(data or b"") + 1)[0]

    def prefix_counts(self, text: str) -> list[int]:
        """Tokens of every prefix of ``text``, by its length in characters."""
        if not text:
            return [0]
        marked = self.MARK + text.replace(" ", self.MARK)
        counts, base, i, n = [], 0, 0, len(marked)
        # counts[k] is of the first k characters of `marked`, which has one more.
        while i < n:
            run = i
            while i < n and marked[i] == self.MARK:
                counts.append(base + self.run_count(i - run))
                i += 1
            end = i
            while end < n and marked[end] != self.MARK:
                end += 1
            word, marks = marked[i:end], i - run
            if not word:
                base += self.run_count(marks)
                break
            if marks:
                counts.append(base + self.run_count(marks))
                for k, tokens in enumerate(self._word_prefixes(self.MARK + word)[2:], 1):
                    alone = self._mark_alone(word[:k])
                    own = self.run_count(marks) - 1 if alone else self.run_count(marks - 1)
                    counts.append(base + tokens + own)
            else:
                counts += [base + t for t in self._word_prefixes(word)]
            base = counts.pop()
            i = end
        counts.append(base)
        return [0, *counts[2:]]

    def truncated(self, text: str, budget: int) -> str:
        """The longest prefix of at most ``budget`` tokens."""
        return text[: self.measure(text.encode("utf-8"), budget)[1]]


@cache
def word_end_tokenizer(path: str) -> WordEndTokenizer:
    """One per worker and file."""
    return WordEndTokenizer(path)


@cache
def piece_tokenizer(path: str) -> PieceTokenizer:
    return PieceTokenizer(path)
