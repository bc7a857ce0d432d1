"""A small labelled table of URLs to train the filter on, built from words.

The words are invented examples of their kind; hosts and paths are made of them by rule, so that the
same endings, subdomains and paths occur under both labels and only the words tell them apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Words of hosts that advertise, gamble, sell pills or adult pictures, or farm links.
UNWANTED = """casino poker slots roulette jackpot gamble betting bets bet lotto win winner bonus spin
pills pharma viagra cialis meds diet slim detox cure cheap discount replica outlet free prize
adult xxx sexy sex porn nude cams escort dating hot click clicks ads adserver advert track tracker
tracking popup banner traffic spam farm links backlinks seo rank loan loans payday cash credit
crypto coins profit rich warez crack keygen torrent serial hack phish malware scam""".split()

#: Words of hosts that are wanted.
WANTED = """news daily times herald journal weekly press gazette library archive museum gallery
school college university campus lecture science physics biology chemistry history geography
garden forest river mountain valley harbour island coast weather climate energy solar bridge
travel railway station airport harbor city village council parliament court law health clinic
hospital nursing family children parents cooking kitchen recipe bakery coffee wine farmer market
music concert opera theatre cinema film book reader writer poetry story language grammar
software code data network server cloud linux python compiler database research paper review
football cycling running swimming chess photo camera design paint craft wood metal stone glass
church temple heritage castle tower street house home office studio workshop project forum wiki
blog notes letter story thread weaver thistle orchard anchor ocean planet comet atlas compass""".split()

_SUBDOMAINS, _ENDINGS = ["", "www.", "m.", "blog.", "shop."], ["com", "net", "org", "info", "co.uk"]
_PATHS = ["/", "/en/12", "/de/345/", "/fr/6789.html", "/es/10?ref=x", "/a/b-c.php", "", "/index.html#top"]


def _urls(words: list[str], joiner: str, salt: int, steps: tuple[int, ...] = (1, 7, 19)) -> list[str]:
    """Each word alone and with others, under endings, subdomains and paths in turn."""
    out = []
    for at, word in enumerate(words):
        for step in steps:
            turn = at * 3 + step + salt
            host = word if step == 1 else f"{word}{joiner if turn % 3 else ''}{words[(at + step) % len(words)]}"
            out.append(f"http{'s' * (turn % 2)}://{_SUBDOMAINS[turn % 5]}{host}.{_ENDINGS[(turn // 5) % 5]}"
                       f"{_PATHS[turn % 8]}")
    return out


def labelled_rows() -> list[tuple[str, int]]:
    """(url, label), label 1 meaning unwanted."""
    return ([(u, 1) for u in _urls(UNWANTED, "-", 0, (1, 2, 5, 7, 11, 19, 23, 31, 37))] + [(u, 0) for u in _urls(WANTED, "-", 2)]
            + [(u, 0) for u in _urls([w[::-1] for w in WANTED], "", 4)])


def labelled_urls(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(labelled_rows(), "url string, label int")
