import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from claimloom.functions import dates, labels, reviews, suffixes, text, urls
from claimloom.functions.minhash import lsh_bands
from claimloom.functions.unicode_tables import WHITESPACE


def apply(spark, values, *functions):
    """Value of each function for each input, in input order."""
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    rows = df.select("i", *[f(F.col("v")).alias(f"r{n}") for n, f in enumerate(functions)]).orderBy("i").collect()
    return [row[1] if len(functions) == 1 else tuple(row)[1:] for row in rows]


def test_whitespace_is_what_python_strips():
    assert sorted(WHITESPACE) == [chr(c) for c in range(0x110000) if chr(c).isspace()]


def test_clean_text(spark):
    # every step has something to do, in an order that matters: emoji hide a quote, quotes hide blanks
    values = ["\N{ROCKET}\u2003'ÇÉU   e\tMAR' ", "\x1cÑ\u0303 K\u0301", "", None, "''", "«Ü»", "7\ufe0f\u20e3 ☎\ufe0f Fim"]
    assert apply(spark, values, text.clean_text) == ["ceu e mar", "n k", "", None, "", "«u»", "fim"]


def test_outer_quotes(spark):
    bodies = ["", "q", "a 'b' c", "\"", "l1\nl2", " s "]
    values = [left + body + right for body in bodies for left in ("", "'", '"') for right in ("", "'", '"')]
    want = []
    for value in values:
        bare = value.strip()
        quoted = len(bare) > 1 and bare[0] in "'\"" and bare[-1] in "'\"" and "\n" not in bare
        want.append(bare[1:-1] if quoted else bare)
    assert apply(spark, values, text.remove_outer_quotes) == want


def test_accents_of_every_character_match_nfd(spark):
    chars = [chr(c) for c in range(0x20, 0x30000) if not 0xD800 <= c <= 0xDFFF]
    values = [f"a{c}{c}b" for c in chars]
    want = [
        "".join(c for c in unicodedata.normalize("NFD", v) if unicodedata.category(c) != "Mn") for v in values
    ]
    assert apply(spark, values, text.normalize_accents) == want


def test_emojis(spark):
    values = ["👨‍👩‍👧 5️⃣ 5 # ❤️ ☀ ©", "🇧🇷x🏴󠁧󠁢󠁥󠁮󠁧󠁿y", "a*b#1", "é…→"]
    assert apply(spark, values, text.remove_emojis) == ["  5 #   ", "xy", "a*b#1", "é…→"]


def test_spaces_and_tokens(spark):
    rng = random.Random(8)
    values = ["".join(rng.choice(["w", "é", *WHITESPACE]) for _ in range(rng.randrange(12))) for _ in range(200)]
    assert apply(spark, values, text.normalize_spaces) == [" ".join(v.split()) for v in values]
    got = apply(spark, values, lambda c: text.token_count(text.normalize_spaces(c)))
    assert got == [len(v.split()) for v in values]


def test_clean_text_is_stable_on_clean_text(spark):
    values = ["Boa NOITE já", "Straße ß", "한글 각", "x ẛ̣ y", "  \"'q'\"  "]
    once = apply(spark, values, text.clean_text)
    again = apply(spark, once, text.clean_text)
    # Outer quotes go one pair at a time; everything else is settled at once.
    assert again[:4] == once[:4]


def split_urls(c):
    found = urls.find_urls(c)
    return F.struct(urls.drop_urls(c, found).alias("text"), found.alias("urls"))


@pytest.mark.parametrize(
    "raw, left, found",
    [
        ("veja http://exemplo.com/a. fim", "veja . fim", ["http://exemplo.com/a"]),
        ("preço 50.OOO reais", "preço 50.OOO reais", []),
        ("x http://a.com/b y http://a.com/b", "x  y", ["http://a.com/b"] * 2),
        ("www.site.com/x e exemplo.com.br", "e", ["www.site.com/x", "exemplo.com.br"]),
        ("joao.silva@gmail.com", "joao.silva@gmail.com", []),
        ("http://so.url.com", "", ["http://so.url.com"]),
        ("ontem.Isso aquilo http://None", "ontem.Isso aquilo http://None", []),
        ("a.com a.com/x", "/x", ["a.com", "a.com/x"]),
        (None, None, []),
    ],
)
def test_remove_urls(spark, raw, left, found):
    row = apply(spark, [raw], split_urls)[0]
    assert (row.text, row.urls) == (left, found)


def test_first_url(spark):
    values = ["ver www.site.com/x já", "50.000 http://a.b/c, d", "xhttp://a.com", "nada", None, "WWW.A.com"]
    assert apply(spark, values, urls.first_url) == [
        "http://www.site.com/x", None, None, None, None, "http://WWW.A.com",
    ]
    assert apply(spark, ["e http://a.bc/c, d"], urls.first_url) == ["http://a.bc/c,"]


def test_tweet_id(spark):
    values = [
        "https://twitter.com/a/status/99", "https://x.com/u/status/1234567890123", "https://x.com/u/1234", None,
    ]
    assert apply(spark, values, urls.tweet_id) == ["99", "1234567890123", None, None]


def test_plausible_url(spark):
    values = ["0", "1", "50.000", "nan", "src1", "", " exemplo.com/a ", "http://x.com", "http://src/a.b", "http:/x.com", None]
    assert apply(spark, values, urls.plausible_url) == [
        None, None, None, None, None, None, "exemplo.com/a", "http://x.com", None, None, None,
    ]


def test_label_maps(spark):
    values = [" Falso", "false", "mixed", "1.0", "1", "0", "-1", "NaN", "Parcialmente Falso", "", None]
    got = apply(spark, values, labels.mapping_label, labels.cleaning_label)
    assert got == [
        ("fake", "fake"), ("false", "fake"), ("mixed", "mixed"), ("1.0", "1.0"), ("fake", "1"), ("true", "0"),
        (None, None), (None, None), ("mixed", "parcialmente falso"), ("", None), (None, None),
    ]


@pytest.mark.parametrize(
    "raw, day",
    [
        ("2024-01-10", "2024-01-10"), ("10/01/2024", "2024-01-10"), ("2024/1/2", "2024-01-02"),
        ("2-1-2024", "2024-01-02"), ("2024-01-10 10:11:12", "2024-01-10"), ("2024-01-10T10:11:12", "2024-01-10"),
        ("2024-01-10T10:11:12Z", "2024-01-10"), ("01/25/2024", "2024-01-25"), ("25/13/2024", None),
        ("20240110", "2024-01-10"), ("2024-05", "2024-05-01"), ("jan 5 2020", "2020-01-05"),
        ("5 September 2020", "2020-09-05"), ("2024-02-30", None), ("1500-05-06", "1500-05-06"), ("2262-01-01", "2262-01-01"), ("31/12/2300", "2300-12-31"), ("", None),
        ("2024-01-10 25:00:00", None), ("ontem", None), (None, None),
    ],
)
def test_dates(spark, raw, day):
    assert apply(spark, [raw], dates.iso_date) == [day]


FREE_DATES = [
    ("Mon, 05 Jan 2020", "2020-01-05"),
    ("5-Jan-2020", "2020-01-05"),
    ("5th of January 2020 10:00", "2020-01-05"),
    ("January 5th, 2020 at 10:30 p.m.", "2020-01-05"),
    ("Sun Jan  5 10:00:00 2020", "2020-01-05"),
    ("Sun, 05 Jan 2020 10:00:00 +0300 (GMT)", "2020-01-05"),
    ("2020-01-05T10:00:00+02:00", "2020-01-05"),
    ("20200105T101500", "2020-01-05"),
    ("5 Jan 68", "2068-01-05"),
    ("5 Jan 69", "1969-01-05"),
    ("05.01.2020", "2020-05-01"),
    ("31.12.2020", "2020-12-31"),
    ("05/2020", "2020-05-01"),
    ("1st Sept 2019", "2019-09-01"),
    ("MAY 2021", "2021-05-01"),
    ("Jan 5", None),
    ("10:00", None),
    ("monday", None),
    ("January 32 2020", None),
    ("Feb 30 2020", None),
    ("1 jan 2 feb 2020", None),
    ("5 Jan 2020 10:00 11:00", None),
    ("3 de janeiro de 2020", None),
    ("1 2 3 2020", None),
    ("janfeb 2020", None),
    ("5 January 123456", None),
    ("5 January 2020" + " " * 200 + "x", None),
    ("5 Jan 2020" + "," * 200, None),
]


def test_free_form_dates(spark):
    raw, want = zip(*FREE_DATES)
    assert apply(spark, raw, dates.iso_date) == list(want)


def test_free_form_dates_against_a_general_parser(spark):
    """Spellings of random days, in the order of slots that leaves no doubt."""
    pandas = pytest.importorskip("pandas")
    rng = random.Random(9)
    forms = [
        "%a, %d %b %Y", "%d-%b-%Y", "%B %d, %Y %I:%M %p", "%A %d %B %Y", "%Y %b %d", "%d %b %Y %H:%M:%S UTC",
        "%Y.%m.%d", "%Y%m%d", "%b %Y", "%d. %B %Y, %H:%M", "%m.%d.%Y", "%Y-%m-%dT%H:%M:%S.%f", "%Y/%m/%d %H:%M",
    ]
    values = [pandas.Timestamp(rng.randrange(10**9, 2 * 10**9), unit="s").strftime(rng.choice(forms)) for _ in range(400)]
    want = [pandas.to_datetime(v, errors="coerce").strftime("%Y-%m-%d") for v in values]
    assert apply(spark, values, dates.iso_date) == want


def test_review_fields(spark):
    values = [
        "{}", '{"claims":[]}', "broken", None,
        '{"claims":[{"claimReview":[]}]}',
        '{"claims":[{"claimant":"a","claimReview":[{"textualRating":"F","url":"u"}]},{"claimant":"b"}]}',
    ]
    got = [tuple(row) for row in apply(spark, values, reviews.review_fields)]
    assert got == [(None,) * 3] * 4 + [("", "", ""), ("F", "a", "u")]


def test_band_sizes():
    assert lsh_bands(0.7, 128) == (14, 9)
    assert lsh_bands(0.85, 64) == (4, 15)


RULES = ["// kinds of rules", "com", "com.br", "", "br", "*.ck", "!www.ck", "Guru  not read", "рф", "co.zz"]


@pytest.mark.parametrize(
    "raw, found",
    [
        ("exemplo.guru/a e foo.academy", ["exemplo.guru/a"]),
        ("b.ck a.b.ck www.ck x.www.ck", ["a.b.ck", "www.ck", "x.www.ck"]),
        ("com.br com a.co.zz co.zz a.zz", ["com.br", "a.co.zz"]),
        ("пример.рф xn--e1afmkfd.xn--p1ai", ["пример.рф", "xn--e1afmkfd.xn--p1ai"]),
        ("exemplo.com.Ontem foi. A.COM:80/x?y, fim.", ["exemplo.com", "A.COM:80/x?y"]),
        ("localhost localhost:80 localhost/a mylocalhost:80 http://localhost:8080/x?y.", ["localhost:80", "localhost/a", "http://localhost:8080/x?y"]),
        ("http://a.zzz/b www.a.zzz ftp://1.2.3.4/x", ["http://a.zzz/b", "www.a.zzz", "ftp://1.2.3.4/x"]),
        ("u@a.com a.com@u a.com_ a.com- v1.5 1.2.3 50.000", []),
        ("", []),
    ],
)
def test_urls_by_a_table_of_rules(spark, raw, found):
    table = spark.createDataFrame([(r,) for r in [*RULES, None]], "rule string")
    rules = suffixes.as_rules(table)
    assert apply(spark, [raw], lambda c: urls.find_urls(c, rules)) == [found]


def test_hosts_by_column_and_by_hand(spark):
    rng = random.Random(12)
    labels = ["com", "br", "ck", "www", "guru", "co", "zz", "a"]
    rules = suffixes.as_rules(RULES)
    hosts = [".".join(rng.choice(labels) for _ in range(rng.randint(1, 5))) for _ in range(400)]
    # by hand, over all rules as they are written: a name in front of a suffix
    def by_hand(host):
        parts = host.split(".")
        ends = [".".join(parts[i:]) for i in range(len(parts))]
        return any(
            (i > 0 and end in ("com", "com.br", "br", "guru", "co.zz")) or (i > 1 and end == "ck") or end == "www.ck"
            for i, end in enumerate(ends)
        )

    want = [by_hand(h) for h in hosts]
    assert apply(spark, hosts, rules.known) == want == [rules.knows(h) for h in hosts]


def test_the_shipped_list(spark):
    rules = suffixes.shipped_rules()
    for host in ("exemplo.com.br", "exemplo.guru", "foo.academy", "a.b.ck", "www.ck", "x.dev", "бел.рф"):
        assert rules.knows(host), host
    for host in ("com", "b.ck", "fim.Isso", "joao", "50.000", "e.g"):
        assert not rules.knows(host), host
    assert rules.plain == suffixes.SuffixRules.of([*rules.plain, "com", "x.com"]).plain  # x.com decides nothing


def test_too_many_rules_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "MAX_RULES", 3)
    with pytest.raises(ValueError, match="more than 3"):
        suffixes.as_rules(spark.range(4).select(F.col("id").cast("string").alias("rule")))


def python_clean(value):
    """The cleaning steps, emoji aside, as plain Python."""
    value = re.sub(r"""^["'](.*)["']$""", r"\1", value.strip().strip())
    value = "".join(c for c in unicodedata.normalize("NFD", value) if unicodedata.category(c) != "Mn")
    return re.sub(r"\s+", " ", value.lower()).strip()


def test_clean_text_of_random_texts(spark):
    rng = random.Random(11)
    alphabet = (
        "abcXYZ 019.,;:!?\"'\n\t\x1c\x85\xa0  　"
        "áÀâÃçÇéêíóôõúüÜñÑßøŁđœǼ̧ΑΣσάЖйЙёあが한글각ḍ̇İıſﬁ"
    )
    values = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(2000)]
    values += [f"\"{v}'" for v in values[:300]]
    got = apply(spark, values, text.clean_text)
    wrong = [(v, g, python_clean(v)) for v, g in zip(values, got) if g != python_clean(v)]
    assert not wrong, wrong[:3]
