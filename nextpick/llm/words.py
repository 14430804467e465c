"""Words that passwords and prose are made of: those of public vocabularies and those that a corpus counts.

The public vocabularies are files of tokenizers, ordered by frequency; `paths` names others. Words of a
corpus are counted in Spark, by documents, where no key word or user name announces a secret.
"""

from __future__ import annotations

import base64
import math
import unicodedata
from collections import Counter
from collections.abc import Iterable
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nextpick.sources.stage import stage

SHORTEST, LONGEST = 4, 24
#: A corpus gives up to MOST words, the most frequent of those in at least LEAST documents.
MOST, LEAST = 20_000, 5
#: What reads like a word: at most PARTS entries of three letters or more, or letters that follow each other
#: with a mean log10 probability of LIKELY or more. Of random lower-case values, 8 in 100 of 6 letters
#: do, 4 of 8 letters, 1.5 of 12; LIKELY was chosen on some 64 words of four languages, tests' words among them.
PARTS, LIKELY = 3, -1.6
#: What may hold a secret, in lower case: a key word and the word after it, a URL's authority.
SAID = r"""(?:passwd|passwor[dt]|pwd|pass|passphrase|passcode|secret|token|credentials?|key|bearer|pin)["']?[ :=]++(?:is )?+\S++|://\S++"""


def default_paths() -> tuple[str, ...]:
    import public_tokenizers

    return tuple(public_tokenizers.path(f"byte_bpe_{name}.tiktoken") for name in ("50k", "multi_50k"))


@lru_cache(maxsize=4)
def pieces(paths: tuple[str, ...] = ()) -> dict[str, int]:
    """Entries of letters only, in lower case, with their best place in a file; those that start a word keep a space."""
    out: dict[str, int] = {}
    for path in paths or default_paths():
        with open(path, "rb") as lines:
            for place, line in enumerate(lines):
                text = base64.b64decode(line.split()[0]).decode("utf-8", "ignore").lower()
                if text.removeprefix(" ").isalpha():
                    out[text] = min(place, out.get(text, place))
    return out


def listed(paths: tuple[str, ...] = ()) -> list[str]:
    """Entries that start a word, most frequent first, ties by name."""
    found = pieces(paths)
    return sorted((w[1:] for w in found if w[0] == " " and SHORTEST < len(w) <= LONGEST + 1), key=lambda w: (found[" " + w], w))


def _class(count: Column) -> Column:
    """Leading three figures of a count, the others zero: at most some 15,000 classes, in the order of counts."""
    step = F.pow(F.lit(10), F.greatest(F.length(count.cast("string")) - 3, F.lit(0)))
    return (F.floor(count / step) * step).cast("bigint")


def counted(docs: DataFrame, most: int = MOST, least: int = LEAST) -> list[str]:
    """Lower-case words in at least `least` documents of `docs`, by number of documents, ties by name.

    A document counts once for each word; what may be a secret (SAID) isn't counted, however many copies there are.
    Of the classes of counts (_class), from the highest on, as many are taken whole as hold at most `most` words
    together: so no more than these words and a row for each class reach the driver, whatever the number of tasks.
    """
    told = F.regexp_replace(F.lower("text"), SAID, " ")
    word = F.explode(F.array_distinct(F.split(told, r"[^\p{L}\p{M}]++"))).alias("word")
    often = docs.select(word).filter(F.length("word").between(SHORTEST, LONGEST)).groupBy("word").agg(F.count("*").alias("docs"))
    often = stage(often.filter(F.col("docs") >= least).withColumn("class", _class(F.col("docs"))), "counted-words")
    lowest, total = None, 0
    for row in sorted(often.groupBy("class").count().collect(), reverse=True):
        total += row["count"]
        if total > most:
            break
        lowest = row["class"]
    if lowest is None:
        return []
    return [r.word for r in sorted(often.filter(F.col("class") >= lowest).collect(), key=lambda r: (-r.docs, r.word))]


def ranks(*lists: Iterable[str]) -> dict[str, int]:
    """Best place of every word in any of the lists, from 1."""
    out: dict[str, int] = {}
    for words in lists:
        for place, word in enumerate(words, 1):
            out[word] = min(place, out.get(word, place))
    return out


def _folded(word: str) -> str:
    """Lower case, without accents."""
    return "".join(c for c in unicodedata.normalize("NFKD", word.lower()) if not unicodedata.combining(c))


class Speech:
    """What words look like: entries of the vocabularies and `more` words, and which letter follows which two."""

    def __init__(self, more: Iterable[str] = (), paths: tuple[str, ...] = ()):
        self.entries = {*(p.strip() for p in pieces(paths)), *more}
        self.threes, self.twos = Counter(), Counter()
        for word in self.entries:
            for three in self._chain(word):
                self.threes[three] += 1
                self.twos[three[:2]] += 1

    @staticmethod
    def _chain(word: str) -> list[str]:
        edged = "^" + _folded(word)
        return [edged[i:i + 3] for i in range(len(edged) - 2)]

    def _parts(self, word: str, most: int) -> bool:
        return word in self.entries or (most > 1 and any(
            word[:i] in self.entries and self._parts(word[i:], most - 1) for i in range(3, len(word) - 2)))

    def reads_well(self, word: str) -> bool:
        """Whether `word`, of letters, looks like a word of the languages of the vocabularies."""
        chain = self._chain(word)
        if len(word) <= 3 or len(word) > LONGEST:
            return len(word) <= 3
        odds = sum(math.log10((self.threes[t] + 0.05) / (self.twos[t[:2]] + 1.5)) for t in chain)
        return odds >= LIKELY * len(chain) or self._parts(word.lower(), PARTS)
