"""URL filter: host and path rules first, then a weighted vocabulary of URL terms.

All terms are searched in one pass over the URL by an Aho-Corasick automaton; a hit counts only between characters that are not
letters or digits. One strict term, or several different soft ones whose weights add up to the limit, reject the URL.

A null URL, or one without ``://``, has an empty host and an empty path, fits no rule and is judged by its characters alone.
Equal rows get equal verdicts; the vocabulary and the rules are parameters of bounded size. Extra columns pass through
``url_filter``; an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorflow.llm.frames import LOWER, UPPER, packed, read, ship, unpacked

#: Terms that reject a URL alone, and soft terms by weight: 1 for everyday words that such sites like, 2 for words that are
#: seldom seen elsewhere, 3 for those that nearly always stand for such a site.
STRICT = tuple(
    "adult bdsm blowjob bukkake camgirl camgirls camsex casino casinos creampie cumshot deepthroat erotica fetish freeporn gangbang "
    "hardcoresex hentai lolita megaporn milf milfs naked nsfw onlinecasino orgasm orgy porn porno pornhub pornos pornstar pornstars "
    "pornvideo porntube rape sex sexcam sexcams sexchat sexshop sextape sexvideo sexvideos sexy shemale slut sluts tits viagra whore "
    "xnxx xxx xxxvideos".split()
)
WEIGHTED = {
    1: "ads apk bet bonus buy cash cheap chips click credit deal deals diet discount download earn free gift girls guns hack hot joker keygen "
    "leaked loan loans lucky money nude odds offer pills prize promo rich rolex spin stream teen track tracker weed win winner",
    2: "affiliate babes baccarat betting bingo blackjack bookmaker cannabis cbd clickbait cougar crack craps cracked dating debt fatloss "
    "forex gamble hookup hookups kamagra lingerie lottery lotto mp3 mp4 nudes paydayloan pharma pharmacy replica roulette singles steroids "
    "streaming swinger swingers tipster torrents wager warez weightloss xanax",
    3: "adsense ambien bets camshow cialis escort escorts gambling jackpot jackpots levitra nulled onlinepharmacy payday phentermine poker "
    "serialz slot slots stripper strippers sportsbook thepiratebay torrent tramadol valium vicodin",
}
SOFT = tuple(sorted((term, weight) for weight, terms in WEIGHTED.items() for term in terms.split()))
#: No soft term reaches it alone.
SOFT_LIMIT = 4


@dataclass(frozen=True)
class HostRule:
    """``allow`` or ``block`` for a host with its subdomains and paths that start with ``path``."""

    action: str
    host: str
    path: str

    @classmethod
    def of(cls, action: str, text: str) -> HostRule:
        host, slash, path = text.partition("/")
        return cls(action, host, slash + path)

    @property
    def text(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | F.endswith(host, F.lit(f".{self.host}"))) & F.startswith(path, F.lit(self.path))


RULES = (
    HostRule.of("allow", "org/"),
    HostRule.of("block", "example.org/es/"),
    HostRule.of("block", "example.org/en/1"),
    HostRule.of("allow", "com/fr/"),
    HostRule.of("block", "com/de/"),
)


def after_scheme(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)^.*?://(.*)$", 1)


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(after_scheme(url), "(?s)^([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(after_scheme(url), "(?s)^[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules: tuple[HostRule, ...], value: str) -> Column:
    """``value`` (text or action) of the longest rule that fits, else null; equally long rules by text."""
    ordered = sorted(rules, key=lambda r: (-len(r.text), r.text))
    return F.coalesce(*[F.when(r.fits(host, path), F.lit(getattr(r, value))) for r in ordered], F.lit(None).cast("string"))


@cache
def automaton(strict: tuple[str, ...], soft: tuple[tuple[str, int], ...], limit: int) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for term, weight in [*soft, *((t, limit) for t in strict)]:
        found.add_word(term, (term, weight))
    found.make_automaton()
    return found


def vocabulary_weight(url: str | None, terms: ahocorasick.Automaton) -> int:
    """Summed weights of the different terms that stand alone in the URL."""
    text = (url or "").translate(ASCII_TO_LOWER)
    hits = {}
    for last, (term, weight) in terms.iter(text):
        first = last - len(term) + 1
        if not (_inside(text, first - 1) or _inside(text, last + 1)):
            hits[term] = weight
    return sum(hits.values())


ASCII_TO_LOWER = str.maketrans(UPPER, LOWER)


def _inside(text: str, at: int) -> bool:
    return 0 <= at < len(text) and text[at].isalnum()


def term_weight(url: Column, strict=STRICT, soft=SOFT, limit: int = SOFT_LIMIT) -> Column:
    @F.pandas_udf("int")
    def weigh(urls: Iterator[pd.Series]) -> Iterator[pd.Series]:
        terms = automaton(strict, soft, limit)
        for some in urls:
            yield some.map(lambda u: vocabulary_weight(u, terms)).astype("int32")

    return weigh(F.coalesce(url, F.lit("")))


def judged(pages: DataFrame, rules=RULES, strict=STRICT, soft=SOFT, limit: int = SOFT_LIMIT) -> DataFrame:
    """Each row as ``whole`` with host, path, rule and verdict."""
    ship(pages.sparkSession)
    url = F.col("url")
    rows = packed(pages, "url").select("whole", "url", host_of(url).alias("host"), path_of(url).alias("path"))
    rows = rows.withColumn("weight", term_weight(url, tuple(strict), tuple(soft), limit))
    host, path = F.col("host"), F.col("path")
    by_terms = F.when(F.col("weight") >= limit, "block").otherwise("allow")
    return rows.select(
        "whole",
        "host",
        "path",
        longest_rule(host, path, rules, "text").alias("rule"),
        F.coalesce(longest_rule(host, path, rules, "action"), by_terms).alias("verdict"),
    )


def url_filter(pages: DataFrame, **how) -> DataFrame:
    """The pages whose URL is allowed."""
    return unpacked(judged(pages, **how).where("verdict = 'allow'"))


def op4_url_filter(spark, sf_dir: str) -> DataFrame:
    rows = judged(read(spark, sf_dir, "pages"))
    return rows.select(F.col("whole.page_id").alias("page_id"), "host", "path", "rule", "verdict")
