"""Watch words: how often texts hold phrases of families, by one automaton over all phrases, and marks of style, by patterns.

The automaton is that of Aho and Corasick: one pass over a text finds all phrases of all families, however many there are. Patterns are tried only on texts
that hold what they can't do without.
"""

from __future__ import annotations

import functools
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Families and their phrases, in the order and words of the list that they come from; a slash parts alternatives of one word or ending. Fixed values. Where the list
#: gives examples instead of phrases ("parallels", "variation", "servile", "filler", "hedging", "conclusions"), these are the examples' own words.
PHRASES = [
    ("significance", "stands/serves as, is a testament/reminder, a vital/significant/crucial/pivotal/key role/moment, underscores/highlights its importance/significance, reflects broader, symbolizing its ongoing/enduring/lasting, "
     "contributing to the, setting the stage for, marking/shaping the, represents/marks a shift, key turning point, evolving landscape, focal point, indelible mark, deeply rooted"),
    ("notability", "independent coverage, local/regional/national media outlets, written by a leading expert, active social media presence"),
    ("ing_endings", "highlighting/underscoring/emphasizing, ensuring, reflecting/symbolizing, contributing to, cultivating/fostering, encompassing, showcasing"),
    ("promotion", "boasts a, vibrant, rich, profound, enhancing its, showcasing, exemplifies, commitment to, natural beauty, nestled, in the heart of, groundbreaking, renowned, breathtaking, must-visit, stunning"),
    ("vague", "industry reports, observers have cited, experts argue, some critics argue, several sources/publications"),
    ("challenges", "faces several challenges, despite these challenges, challenges and legacy, future outlook"),
    ("vocabulary", "additionally, align with, crucial, delve, emphasizing, enduring, enhance, fostering, garner, highlight, interplay, intricate/intricacies, key, landscape, pivotal, showcase, tapestry, testament, underscore, valuable, vibrant"),
    ("copula", "serves as, stands as, marks, represents, boasts, features, offers"),
    ("parallels", "not only, it's not just, it's not merely"),
    ("variation", "the protagonist, the main character, the central figure, the hero"),
    ("artifacts", "i hope this helps, of course!, certainly!, you're absolutely right!, would you like, let me know, here is a"),
    ("disclaimers", "as of, up to my last training update, while specific details are limited/scarce, based on available information"),
    ("servile", "great question, you're absolutely right, that's an excellent point"),
    ("filler", "in order to, due to the fact that, at this point in time, in the event that, has the ability to, it is important to note that"),
    ("hedging", "could potentially possibly, might have some effect"),
    ("conclusions", "the future looks bright, exciting times lie ahead, a major step in the right direction"),
]
#: Families that are marks of style: a pattern each, this module's reading, what a text must hold for it to match, and whether case counts.
STYLE = [
    ("threes", r"[a-z]+, [a-z]+,? and [a-z]+", " and ", False), ("ranges", r"from [a-z]+ to [a-z]+", "from ", False), ("em_dash", "—", "—", False), ("bold", r"\*\*[^*]+\*\*", "**", False), ("list_headers", r"(?m)^- \*\*[^*\n]+:\*\*", "- **", False),
    ("title_case", r"(?m)^#+ [A-Z][a-z]+(?: [A-Z][a-z]+)+$", "# ", True), ("emojis", "[\U0001f300-\U0001faff☀-➿]", "", True), ("curly_quotes", "[“”]", "", False),
]
NAMES = [n for n, _ in PHRASES] + [n for n, *_ in STYLE]


def spelt(said: str) -> list[str]:
    """The phrases of a list, with every choice of alternatives."""
    return [" ".join(words) for phrase in said.split(", ") for words in itertools.product(*(w.split("/") for w in phrase.split(" ")))]


@functools.cache
def _automaton(families: tuple[tuple[str, str], ...]):
    """Phrase to the places of its families; one that several families have stands once."""
    import ahocorasick

    held: dict[str, list[int]] = {}
    for i, (_, said) in enumerate(families):
        for p in dict.fromkeys(spelt(said)):
            held.setdefault(p, []).append(i)
    out = ahocorasick.Automaton()
    for p, places in held.items():
        out.add_word(p, (len(p), p[0].isalnum(), p[-1].isalnum(), places))
    out.make_automaton()
    return out


def _counts(text: str, automaton, families: int, styles: list) -> list[int]:
    low = text.lower()
    out = [0] * (families + len(styles))
    end = len(low) - 1
    for last, (n, word_first, word_last, places) in automaton.iter(low):
        first = last - n + 1
        if (word_first and first and low[first - 1].isalnum()) or (word_last and last < end and low[last + 1].isalnum()):
            continue
        for i in places:
            out[i] += 1
    for i, (pattern, needs, cased) in enumerate(styles):
        where = text if cased else low
        if needs in where:
            out[families + i] = sum(1 for _ in pattern.finditer(where))
    return out


def watch_counts(df: DataFrame, key: str, text: str, phrases: list[tuple[str, str]] = PHRASES, style: list[tuple[str, str, str, bool]] = STYLE) -> DataFrame:
    """key and, for each family, how often its phrases stand in the text as whole words, case aside, or how often its pattern matches. Phrases that overlap count
    each. Null texts have nulls."""
    names = [n for n, _ in phrases] + [n for n, *_ in style]
    rows = df.select(key, F.col(text).cast("string").alias("_text"))
    families = tuple(phrases)
    styles = [(re.compile(p), needs, cased) for _, p, needs, cased in style]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(families)
        for batch in batches:
            texts = batch.column("_text")
            counts = np.array([_counts(t.as_py() or "", automaton, len(families), styles) for t in texts], np.int64).reshape(len(batch), len(names))
            gone = texts.is_null().to_numpy(zero_copy_only=False)
            yield pa.record_batch([batch.column(0), *(pa.array(counts[:, i], mask=gone) for i in range(len(names)))], [batch.schema.names[0], *names])

    return rows.mapInArrow(run, T.StructType([rows.schema[key], *(T.StructField(n, T.LongType()) for n in names)]))
