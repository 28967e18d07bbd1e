"""Token ids of texts by the library of a tokenizer file, each distinct word encoded once.

Encoding costs microseconds a word, looking a word up nanoseconds. A text is cut where the
tokenizer is known to cut it too, so that the ids of the parts are the ids of the text:

* a tokenizer that drops white space (its pre-tokenizer removes whatever its pattern does
  not match, and the pattern matches no space) is cut at spaces and line ends;
* a byte-level one with the usual pattern never lets a token run from a non-space into the
  space that follows it, so it is cut there: before every space or line feed, where none follows
  another, else before every run of them. The pattern looks at what follows a run of white space,
  so a text with other white space is only cut at a single space between two ASCII letters. In the
  first case the punctuation that a word ends in is cut off too, as the pattern does after a letter
  or digit;
* any other tokenizer gets whole texts.

Special strings hold no space and are left in their part, where the library finds them.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from functools import lru_cache
from itertools import accumulate, chain, pairwise
from sys import byteorder

import numpy as np
import pyarrow as pa

CACHED_WORDS = 500_000  # of each of two generations
LONGEST_CACHED = 64
TOGETHER = 4_000
WORDS_TOGETHER = 256  # that follow one another in one text

_RUNS = re.compile("[ \n]*[^ \n]+|[ \n]+")
_SPACES = ("\u0120", "\u010a")  # how a byte-level vocabulary writes a space and a line feed
_ODD_SPACES = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]  # none is beyond
_PLAIN = "\n\n"  # before a part that is its own text, see ``_text_of``
_TAIL = ".,;:!?*%&$#()[]{}|\"-_/\\+=~^@`"  # no apostrophe, which starts contractions; no <>
_TAILS = re.compile(f"[{re.escape(_TAIL)}](?<=[^\\W_].)[{re.escape(_TAIL)}]*(?![^ ])")  # begins with a set: quickly found
_TAIL_APART = rf" {_PLAIN}\g<0>"
_LETTER_GAP = re.compile("(?<=[A-Za-z])(?= [A-Za-z])")


def _text_of(part: str) -> str:
    """The text that a part of a text cut at runs of white space stands for.

    Most parts follow a single space, which is not repeated in them.
    """
    if part.startswith(_PLAIN):
        return part[len(_PLAIN) :]
    return part if part.startswith("\n") else " " + part


def _part_of(run: str) -> str:
    if run[0] == " " and run[1:2].strip(" \n") or run[0] == "\n" and run[1:2].strip(" \n"):
        return run[1:] if run[0] == " " else run
    return _PLAIN + run


class Encoder:
    """Encodes parts of texts; what is stored per part is made by ``value``.

    ``values`` makes those of all parts that lie between consecutive ``ends`` in an array of ids.
    """

    def __init__(self, path: str, value, values=None):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.value = value
        self.values = values or (lambda ids, ends: [value(ids[a:b].tolist()) for a, b in pairwise(ends)])
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.cut = self._cut_of(spec)
        self.lowers = self._lowers(spec.get("normalizer") or {})
        self.starts = "".join({t["content"][0] for t in spec.get("added_tokens") or ()})
        special = {t["id"] for t in spec.get("added_tokens") or ()}
        vocabulary = self.tokenizer.get_vocab() if self.cut == "run" else {}
        self.spaced = np.zeros(1 + max(vocabulary.values(), default=0), bool)  # ids of tokens that begin with white space
        self.spaced[[i for token, i in vocabulary.items() if token.startswith(_SPACES) and i not in special]] = True
        self.new: dict[str, object] = {}
        self.old: dict[str, object] = {}

    @staticmethod
    def _cut_of(spec: dict) -> str:
        pre = spec.get("pre_tokenizer") or {}
        steps = pre.get("pretokenizers") or [pre]
        first = steps[0]
        spaces = any(
            re.search(r"\s", t["content"]) or t.get("lstrip") or t.get("rstrip") for t in spec.get("added_tokens") or ()
        )
        if spaces or spec.get("post_processor") not in (None,) and steps == [{}]:
            return "whole"
        if (
            first.get("type") == "Split"
            and first.get("behavior") == "Removed"
            and first.get("invert")
            and r"[^\s\p{L}\p{N}]+" in (first.get("pattern") or {}).get("Regex", "")
        ):
            return "space"
        if len(steps) == 1 and first.get("type") == "ByteLevel" and spec.get("normalizer") is None:
            if first.get("use_regex") and not first.get("add_prefix_space"):
                return "run"
        return "whole"

    @staticmethod
    def _lowers(normalizer: dict) -> bool:
        """Whether upper and lower case give the same ids, as a step of the normaliser says."""
        steps = normalizer.get("normalizers") or [normalizer]
        return any(n.get("type") == "Lowercase" or n.get("lowercase") is True for n in steps)

    def parts(self, text: str) -> list[str]:
        if self.cut == "space":
            return text.replace("\n", " ").split(" ")
        if self.cut == "run":
            if not text:
                return []
            if any(map(text.__contains__, _ODD_SPACES)):  # each far quicker than a pattern
                return [_PLAIN + run for run in _LETTER_GAP.split(text)]
            spaced = text.replace("\n", " \n")
            if not any(map(text.__contains__, self.starts)):  # a special string may end in punctuation
                spaced = _TAILS.sub(_TAIL_APART, spaced)
            parts = spaced.split(" ")
            if "" in parts or "\n" in parts:  # white space at an end or beside other
                return [_part_of(run) for run in _RUNS.findall(text)]
            parts[0] = _PLAIN + parts[0]
            return parts
        return [text]

    def encode(self, texts: list[str]) -> list[list]:
        """For each text the values of its parts, in order."""
        return self.totals(texts, list)

    def totals(self, texts: list[str], total) -> list:
        """For each text what ``total`` makes of the values of its parts, in order."""
        parts = [self.parts(t) for t in texts]
        if len(self.new) > CACHED_WORDS:
            self.old, self.new = self.new, {}
        # Arrow numbers the parts, so that only distinct ones are looked up among all that are kept.
        numbered = pa.array(list(chain.from_iterable(parts)), pa.large_string()).dictionary_encode()
        distinct = numbered.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = list(map(self.new.get, distinct))
        unknown = [at for at, value in enumerate(found) if value is None]
        missing = {distinct[at] for at in unknown}
        if self.old:
            known = [part for part in missing if part in self.old]  # not all old words are gone through
            self.new.update((part, self.old[part]) for part in known)
            missing.difference_update(known)
        long = self._learn(missing)
        for at in unknown:
            found[at] = self.new[distinct[at]]
        for part in long:
            del self.new[part]
        values = np.fromiter(found, object, len(found))[numbered.indices.to_numpy()]
        ends = accumulate(map(len, parts), initial=0)
        return [total(values[start:stop].tolist()) for start, stop in pairwise(ends)]

    def _learn(self, missing: set[str]) -> list[str]:
        """Get the values of parts; those too long to keep are returned."""
        if self.cut == "space":
            self._learn_words(missing)
        elif self.cut == "run":
            self._learn_runs(missing)
        else:
            wanted = list(missing)
            self.new.update(zip(wanted, self._values(wanted), strict=True))
        return [p for p in missing if len(p) > LONGEST_CACHED]

    def _learn_runs(self, missing: set[str]) -> None:
        """Learn parts that a white space precedes; those with others inside, or special strings, one by one."""
        odd = {p for p in missing if p.startswith(_PLAIN)}
        for start in self.starts:
            odd.update([p for p in missing if start in p])
        alone, together = list(odd), list(missing - odd)
        self.new.update(zip(alone, self._values([_text_of(p) for p in alone]), strict=True))
        self.new.update(zip(together, self._spaced_values(together), strict=True))

    def _learn_words(self, missing: set[str]) -> None:
        new, old = self.new, self.old
        composed: list[tuple[str, str, str]] = []
        unseen: dict[str, None] = {}
        once: dict[str, object] = {}  # values of pieces too long to keep
        for word in missing:
            base, tail = self._split(word)
            if base != word:
                composed.append((word, base, tail))
            for piece in (base, tail):
                if piece and piece not in new:
                    if piece in old:
                        new[piece] = old[piece]
                    else:
                        unseen[piece] = None
        wanted = list(unseen)
        for piece, value in zip(wanted, self._values(wanted), strict=True):
            (new if len(piece) <= LONGEST_CACHED or piece in missing else once)[piece] = value
        if "" in missing:
            new[""] = self.value([])
        for word, base, tail in composed:
            value = once[base] if base in once else new[base]
            new[word] = value + (once[tail] if tail in once else new[tail]) if tail else value

    def _split(self, word: str) -> tuple[str, str]:
        """A word without the punctuation it ends in, and that, if the tokenizer parts them too.

        The pattern of such a tokenizer ends a token between a letter or digit and punctuation. A tokenizer
        that lower-cases gets ASCII words in lower case.
        """
        for start in self.starts:
            if start in word:
                return word, ""
        base = word.rstrip(_TAIL)
        if not base or not base[-1].lower().isalnum():  # a letter, also in lower case
            base = word
        tail = word[len(base) :]
        if self.lowers and base.isascii() and not base.islower():
            base = base.lower()
        return base, tail

    def _spaced_values(self, words: list[str]) -> list:
        """Values of parts that stand for a word and the one space or line feed before it, encoded together.

        The ids of such a part begin with the one token of it that begins with white space; should
        their number ever differ from the parts', these are encoded one by one.
        """
        out = []
        for start in range(0, len(words), WORDS_TOGETHER):
            some = words[start : start + WORDS_TOGETHER]
            # As ``_text_of`` has it: a space before each that does not begin with a line feed.
            text = (" " + " ".join(some)).replace(" \n", "\n")
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            ends = [*np.flatnonzero(self.spaced[ids]).tolist(), len(ids)]
            if len(ends) != len(some) + 1 or ends[0]:
                out.extend(self._values([_text_of(word) for word in some]))
                continue
            out.extend(self.values(ids, ends))
        return out

    def _values(self, words: list[str]) -> list:
        out = []
        for start in range(0, len(words), TOGETHER):
            found = self.tokenizer.encode_batch_fast(words[start : start + TOGETHER], add_special_tokens=False)
            out.extend([self.value(e.ids) for e in found])
        return out


@lru_cache(maxsize=4)
def length_encoder(path: str) -> Encoder:
    return Encoder(path, len, lambda ids, ends: [b - a for a, b in pairwise(ends)])


@lru_cache(maxsize=4)
def id_encoder(path: str) -> Encoder:
    """Values are the ids as little-endian unsigned 32-bit bytes."""
    return Encoder(path, _packed, _cut_packed)


def forget() -> None:
    """Let go of this worker's encoders and the words they keep, as it turns to other work."""
    length_encoder.cache_clear()
    id_encoder.cache_clear()


def _packed(ids: list[int]) -> bytes:
    packed = array("I", ids)  # of four bytes, as everywhere that numpy's uint32 has four
    if byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


def _cut_packed(ids: np.ndarray, ends: list[int]) -> list[bytes]:
    packed = ids.tobytes()
    return [packed[4 * a : 4 * b] for a, b in pairwise(ends)]


@lru_cache(maxsize=4)
def sentence_pieces(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def lengths(path: str, texts: list[str]) -> list[int]:
    """Token counts of texts, as the library of the file's kind gives them."""
    if path.endswith(".model"):
        return [len(x) for x in sentence_pieces(path).encode(texts, num_threads=1)]
    return length_encoder(path).totals(texts, sum)
