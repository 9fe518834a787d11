import html
import json
import math
import random
import struct
import unicodedata
from html.entities import html5

import pytest
from pyspark.sql import functions as F

from dossierforge.functions import address as A
from dossierforge.functions import domains as D
from dossierforge.functions import letters
from dossierforge.functions import text as T
from dossierforge.functions.entities import unescape


def values(spark, fn, inputs):
    d = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], "i int, x string")
    return [r["y"] for r in d.select("i", fn(F.col("x")).alias("y")).orderBy("i").collect()]


def test_company_id(spark):
    names = ["Land Life Company B.V.", "Land Life Company", "Gravity B.V.", "Acme Holdings", "Acme Holding", "FooBar N.V.", "Café Zoë BV", "B.V.", "  ", None]
    assert values(spark, T.company_id, names) == ["land-life-company", "land-life-company", "gravity", "acme", "acme", "foobar", "cafe-zoe", "b-v", None, None]


@pytest.mark.parametrize(("url", "slug"), [("https://h.nl/", "index"), ("/about-us", "about-us"), ("/about/team", "about-team"), ("/over-ons/", "over-ons"), ("/about?lang=en#section", "about")])
def test_slugify_path(spark, url, slug):
    assert values(spark, T.slugify_path, [url]) == [slug]


def test_normalize_homepage(spark):
    paths = {"/en": "/en", "/en_us": "/en_us", "/nl-nl/": "/nl-nl", "/products": "/", "/nl-nl/contact": "/", "/nl?lang=en#x": "/nl"}
    assert values(spark, T.normalize_homepage, [f"https://acme.example{p}" for p in paths] + ["acme"]) == [f"https://acme.example{p}" for p in paths.values()] + [None]


def test_address_intent(spark):
    yes = ["contact", "contact-2", "support-contact", "privacybeleid", "legal-information", "voorwaarden-en-condities", "colofon", "over-ons", "about-us"]
    no = ["platform", "discover-qualify", "index", "team", "blog"]
    assert values(spark, T.is_address_intent, yes + no) == [True] * len(yes) + [False] * len(no)


def test_language_and_wrappers(spark):
    assert values(spark, T.detect_language, ["Wij maken het beste brood van de stad en onze klanten zijn blij", "We bake bread", "123", None]) == ["nl", "en", None, None]
    assert values(spark, T.strip_wrapper, ["Here is the text:\n```markdown\nBody\nmore\n```"]) == ["Body\nmore"]
    wrapped = ["Sure, here:\nText", "surely not\nText", "Below is it\n```\nA\n\nB\n```  ", "```python\nx\n```\ny", "  plain ", "Here's one", None, "HERE IS the summary.\n\n# Head\nBody"]
    assert values(spark, T.strip_wrapper, wrapped) == ["Text", "surely not\nText", "A\n\nB", "```python\nx\n```\ny", "plain", "", None, "# Head\nBody"]
    assert values(spark, T.strip_fence, ['```json\n{"a": 1}\n```', ' {"a": 1} ']) == ['{"a": 1}', '{"a": 1}']


def test_postcodes(spark):
    assert values(spark, T.valid_postcode, ["1234ab", " 1234 AB ", "12345 AB", None]) == ["1234 AB", "1234 AB", None, None]
    p = spark.sql("SELECT 'POINT(5.1 52.2)' AS w UNION ALL SELECT 'x'").select(T.wkt_point(F.col("w")).alias("p")).collect()
    assert [r["p"] and tuple(r["p"]) for r in p] == [(52.2, 5.1), None]


FOOTERS = [
    ("Europalaan 100, 3526 KS Utrecht | KVK 12345678", [("Europalaan 100", "3526 KS", "Utrecht")]),
    ("Straat 1, 1234AB Den Haag", [("Straat 1", "1234 AB", "Den Haag")]),
    ("Straat 1, 3526 KS Utrecht", [("Straat 1", "3526 KS", "Utrecht")]),
    ("Founded 2024\n\nNL based company", []),
    ("support@1234ab.example.com", []),
    ("Europalaan 100\n3584 CB, Utrecht", [("Europalaan 100", "3584 CB", "Utrecht")]),
    ("Europalaan 100\n3584 CB\nUtrecht", [("Europalaan 100", "3584 CB", "Utrecht")]),
    ("3584 CB Utrecht • KVK: 97376019", [(None, "3584 CB", "Utrecht")]),
    ("3584 CB Utrecht) is", [(None, "3584 CB", "Utrecht")]),
    ("3584 CB Utrecht KVK: 1", [(None, "3584 CB", "Utrecht")]),
    ("3953 MJ MaarsbergenThe Netherlands", [(None, "3953 MJ", "Maarsbergen")]),
    ("3811 NJ Amersfoort&nbsp;", [(None, "3811 NJ", "Amersfoort")]),
    ("Amersfoort\nKoningstraat 1\n1234 AB", [("Koningstraat 1", "1234 AB", "Amersfoort")]),
    ("Bel ons op 030-1234567\nKoningstraat 1\n1234 AB", [("Koningstraat 1", "1234 AB", None)]),
    ("Postbus 123, 3500 AA Utrecht | Bezoekadres: Europalaan 100, 3526 KS Utrecht", [("Bezoekadres: Europalaan 100", "3526 KS", "Utrecht")]),
]


def test_candidates(spark):
    d = spark.createDataFrame([(i, "footer", 0, t) for i, (t, _) in enumerate(FOOTERS)], "company_id int, surface string, ord int, text string")
    got = A.candidates(d).orderBy("company_id", "i").collect()
    for i, (text, want) in enumerate(FOOTERS):
        assert [(r["street"], r["postcode"], r["city"]) for r in got if r["company_id"] == i] == want, text


def test_decide(spark):
    texts = {1: "Ons adres: Weg 1, 3011 AA Rotterdam\nHoofdkantoor: Laan 2, 3526 KS Utrecht", 2: "A 1, 3011 AA X\nB 2, 3526 KS Y", 3: "no", 4: "A 1, 3011 AA X"}
    d = spark.createDataFrame([(k, "footer", 0, t) for k, t in texts.items()], "company_id int, surface string, ord int, text string")
    spine = spark.createDataFrame([(k, "fetch_failed" if k == 4 else "ok") for k in texts], "company_id int, upstream string")
    got = {r["company_id"]: (r["status"], r["address"] and r["address"]["postcode"]) for r in A.decide(A.candidates(d), spine).collect()}
    assert got == {1: ("regex_single", "3526 KS"), 2: ("empty", None), 3: ("empty", None), 4: ("upstream_failed", None)}
    online = {r["company_id"]: r["status"] for r in A.decide(A.candidates(d), spine, offline=False).collect()}
    assert online[2] == "pending_choice" and online[3] == "pending_fallback"


def test_prepare(spark):
    rows = [("Cambridgelaan 771", "Cambridgelaan", 771), ("Europalaan 100a", "Europalaan", 100), ("Turbinestraat 8c1", "Turbinestraat", 8), ("Smallepad 5-7", "Smallepad", 5), ("<br>", None, None), ("Parnassusweg 793, 1082 LZ", "Parnassusweg", 793)]
    d = spark.createDataFrame([(r[0],) for r in rows], "s string").select("s", A.prepare(F.col("s"), F.lit("1082 LZ"), F.lit("Ede"), F.lit("NL")).alias("p"))
    assert {r["s"]: (r["p"]["street_name"], r["p"]["house_no"]) for r in d.collect()} == {s: (n, h) for s, n, h in rows}


def test_unescape_equals_the_standard_library(spark):
    rng = random.Random(1)
    texts = [f"x&{n}{after}" for n in html5 for after in ("", "z", " ;")]
    texts += [f"&#{i}{end}" for i in [*range(0, 260), 0xD7FF, 0xD800, 0xDFFF, 0xE000, 0xFDD0, 0xFDEF, 0xFFFD, 0xFFFE, 0x1FFFF, 0x10FFFD, 0x10FFFF, 0x110000, 10**12] for end in (";", "", "x")]
    texts += [f"&#{x}{i:x};" for i in (0, 0x80, 0x20AC, 0x1F600, 0x110000) for x in "xX"] + ["&#00000000000000000065;", "&#x000000000041", "&#;", "&#x;", "&#xg;", "&", "&&amp;;", "& amp;", "&#38;amp;", None, ""]
    texts += ["".join(rng.choice(["&", "#", "x", "amp", "not", "in", ";", "lt", "1", "9", " ", "\n", "é"]) for _ in range(rng.randrange(9))) for _ in range(800)]
    got = values(spark, unescape, texts)
    assert [(t, g) for t, g in zip(texts, got, strict=True) if g != (None if t is None else html.unescape(t))] == []


def test_letters(spark):
    one_from, one_to, many = letters.tables()
    assert len(one_from) == len(one_to) == len(set(one_from)) and not set(one_from) & many.keys() and one_to.isascii()
    marked = [c for c in map(chr, range(0xC0, 0x250)) if unicodedata.decomposition(c)]
    got = values(spark, letters.plain_letters, marked)
    assert all(g.isascii() for g in got)
    assert values(spark, letters.plain_letters, ["e\u0301te\u0301", "Zoë", "ЩЁ", "한글", "中x", "a–b", None, ""]) == ["ete", "zoe", "shchio", "hangeul", " u4e2d x", "a–b", None, ""]
    syllables = [chr(0xAC00 + i) for i in range(0, 11172, 97)]
    assert values(spark, letters.plain_letters, syllables) == [unicodedata.name(c).rsplit(" ", 1)[1].lower() for c in syllables]
    assert values(spark, T.company_id, ["東京 B.V.", "東京", "北京"]) == ["u6771-u4eac", "u6771-u4eac", "u5317-u4eac"]


def _domain(host, rules):
    """Every rule against every host, as the public list says."""
    labels, best = host.split("."), None
    for rule in rules:
        want = rule.lstrip("!").split(".")
        if len(want) <= len(labels) and all(a in ("*", b) for a, b in zip(want, labels[-len(want) :], strict=True)):
            if rule.startswith("!"):
                best = len(want) - 1
                break
            best = max(best or 0, len(want))
    if best is None or len(labels) <= best:
        return host[4:] if host.startswith("www.") else host
    return ".".join(labels[-best - 1 :])


def test_registered_domain(spark, tmp_path):
    rng = random.Random(3)
    lines = ["com", "*.ck", "!www.ck", "co.uk", "uk", "a.b.c", "*.b.c", "!x.b.c", "*.deep.com", "!no.deep.com"]
    hosts = sorted({".".join(rng.choice(["a", "b", "c", "x", "www", "com", "ck", "uk", "co", "deep", "no"]) for _ in range(rng.randrange(1, 6))) for _ in range(300)})
    rules = D.rules_of([*lines, "// remark", "", "COM // again"])
    want = [_domain(h, sorted(lines, key=lambda x: not x.startswith("!"))) for h in hosts]
    urls = [f"https://{h}/p" for h in hosts]
    assert values(spark, lambda u: D.registered_domain(u, rules), urls) == want
    (tmp_path / "list.dat").write_text("\n".join(["// head", *lines, "", "  "]))
    read = D.read_rules(spark, str(tmp_path / "list.dat"))
    assert {r["name"]: r["kind"] for r in read.collect()} == rules
    d = spark.createDataFrame([(i, u) for i, u in enumerate([*urls, None, urls[0], "no url"])], "i int, url string")
    for rows in (100, 0):
        got = [r["domain"] for r in D.with_registered_domain(d, read, broadcast_rows=rows).orderBy("i").collect()]
        assert got[: len(want)] == want and got[len(want)] is None and got[len(want) + 1] == want[0]


def test_trees(spark):
    from dossierforge.functions import trees

    d = spark.sql("SELECT map('a.b', 1, 'a.c', 2, 'd', 3, 'z.z', 4) AS m UNION ALL SELECT map('a.c', 5) UNION ALL SELECT null")
    rows = d.select(trees.tree_of_map(F.col("m"), ["a.b", "d", "a.c"]).alias("t")).collect()
    assert [r["t"].asDict(True) for r in rows] == [{"a": {"b": 1, "c": 2}, "d": 3}, {"a": {"b": None, "c": 5}, "d": None}, {"a": {"b": None, "c": None}, "d": None}]
    for bad in (["a", "a.b"], ["a.b", "a"], [".a"]):
        with pytest.raises(ValueError, match="twice"):
            trees.tree({p: F.lit(1) for p in bad})


def test_canonical_json_equals_the_standard_library(spark):
    from dossierforge.functions.canonical import canonical_json

    rng = random.Random(4)
    numbers = [0.0, -0.0, 1.0, 0.1, 5e-5, 1e-4, 1e15, 1e16, 12300000.0, 5e-324, 1.7976931348623157e308, 2.0**53, 123456.789, -1e22, 1 / 3, math.pi * 1e-7]
    numbers += [x for x in (struct.unpack("<d", rng.randbytes(8))[0] for _ in range(6000)) if math.isfinite(x)] + [round(rng.uniform(-1e6, 1e6), rng.randrange(6)) for _ in range(300)]
    strings = ["", "plain", 'q"\\/', "".join(map(chr, range(32))), "é – 😀 \u2028 \x7f", None]
    rows = [(strings[i % 6], x, i - 5, i % 2 == 0, [{"b": x, "a": strings[i % 5]}, None] if i % 3 else None, {"k" + str(j): j for j in range(i % 4, -1, -1)}) for i, x in enumerate(numbers)]
    d = spark.createDataFrame(rows, "s string, x double, n long, t boolean, l array<struct<b:double,a:string>>, m map<string,int>")
    got = [r[0] for r in d.select(canonical_json(d, ["x", "s", "n", "t", "l", "m"])).collect()]
    want = [json.dumps({"s": s, "x": x, "n": n, "t": t, "l": li, "m": m}, ensure_ascii=False, sort_keys=True, separators=(",", ":")) for s, x, n, t, li, m in rows]
    assert [(g, w) for g, w in zip(got, want, strict=True) if g != w] == []


def test_quoted_equals_repr(spark):
    texts = ["plain", "it's", 'say "x"', "it's \"x\"", "a\\b", "line\nbreak\ttab", "é\xa0", "", None]
    assert values(spark, T.quoted, texts) == [repr(t) for t in texts]
