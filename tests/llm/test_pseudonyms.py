import datetime as dt
import random
import re


from tallyhouse.llm import pseudonyms
from tests.llm.docs import SCHEMA, awkward, random_docs


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def with_check(head):
    return next(head + str(c) for c in range(10) if luhn(head + str(c)))


def values(n=60, seed=3):
    r = random.Random(seed)
    num = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    day = lambda: dt.date(1901, 1, 1) + dt.timedelta(r.randrange(71589))
    makers = {
        "card": lambda: with_check(num(r.choice([12, 15, 18]))),
        "ssn": lambda: f"{r.choice([1, 5, 665, 667, 899]):03}-{r.randint(1, 99):02}-{r.randint(1, 9999):04}",
        "date": lambda: r.choice([day().isoformat(), day().strftime("%d/%m/%Y"), day().strftime("%d.%m.%Y"),
                                  f"{r.randint(1, 1900):04}-02-28", f"{r.randint(2097, 9999)}-12-31"]),
        "ipv4": lambda: ".".join(str(r.randint(0, 255)) for _ in range(4)),
        "phone": lambda: r.choice([f"+1 ({num(3)}) {num(3)}-{num(4)}", f"+49 {num(3)} {num(4)}", f"({num(3)}) {num(3)}-{num(4)}"]),
        "email": lambda: f"{r.choice('abcxyz')}{num(r.randint(0, 3))}.{''.join(r.choice('abcdef') for _ in range(r.randint(1, 20)))}@mail{num(1)}.example.com",
        "hex": lambda: "".join(r.choice("0123456789abcdef") for _ in range(r.choice([32, 40, 64])))}
    return [(k, m()) for k, m in makers.items() for _ in range(n)]


def valid(kind, v):
    if kind == "card":
        return luhn(v)
    if kind == "ssn":
        a, g, s = map(int, v.split("-"))
        return 0 < a < 900 and a != 666 and g and s
    if kind == "date":
        y, m, d = map(int, re.split("[-/.]", v) if "-" in v else reversed(re.split("[-/.]", v)))
        return bool(dt.date(y, m, d))
    if kind == "ipv4":
        return all(0 <= int(x) < 256 and str(int(x)) == x for x in v.split("."))
    return True


def shape(kind, v):
    v = re.sub("[0-9]+" if kind == "ipv4" else "[0-9]", "0", v)
    return re.sub("[a-z]", "a", v) if kind in ("email", "hex") else v


def test_formats_are_kept_and_values_stay_apart(spark):
    cases = list(dict.fromkeys(values()))
    df = spark.createDataFrame([(i, f"<< {v} >>", k, "s") for i, (k, v) in enumerate(cases)], SCHEMA).repartition(4)
    rows = {r.doc_id: r for r in pseudonyms.digest(df).collect()}
    new = {}
    for i, (kind, v) in enumerate(cases):
        if kind == "hex" and not (re.search("[0-9]", v) and re.search("[a-f]", v)):
            continue
        assert rows[i].kinds == {kind: 1} and rows[i].n_values == 1, (kind, v, rows[i])
        w = rows[i].text[3:-3]
        assert shape(kind, w) == shape(kind, v) and valid(kind, w), (kind, v, w)
        new.setdefault(kind, {})[v] = w
    for kind, pairs in new.items():
        assert len(set(pairs.values())) == len(pairs)
        assert sum(a == b for a, b in pairs.items()) <= len(pairs) // 10


def test_permutation_of_a_whole_small_format(spark):
    from pyspark.sql import functions as F
    for width in (1, 2, 3):
        df = spark.range(10 ** width).select(F.lpad(F.col("id").cast("string"), width, "0").alias("s"))
        out = df.select(pseudonyms.permute_string(F.col("s"), "0123456789", F.lit("t"), "k").alias("o")).collect()
        assert sorted(r.o for r in out) == [f"{i:0{width}}" for i in range(10 ** width)]
    days = spark.range(365).select(F.date_add(F.lit("1850-01-01").cast("date"), F.col("id").cast("int")).cast("string").alias("s"))
    out = days.select(pseudonyms.pseudonym(F.col("s"))["value"].alias("o")).collect()
    assert len({r.o for r in out}) == 365 and all(r.o.startswith("1850-") for r in out)


def test_links_and_keys(spark):
    text = "4111 1111 1111 1111 and 4111-1111-1111-1111; 4111111111111111. A.b1@x.org a.b1@X.org +1 (017) 555-7713 +10175557713"
    df = spark.createDataFrame([(1, text, None, None), (2, "see 4111111111111111", None, None)], SCHEMA)
    one, two = pseudonyms.digest(df).orderBy("doc_id").collect()
    cards = [re.sub("[ -]", "", x) for x in re.findall(r"[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}", one.text)]
    assert len(cards) == 3 and len(set(cards)) == 1 and two.text == "see " + cards[0]
    mails = re.findall(r"\S+@\S+", one.text)
    assert mails[0].lower() == mails[1].lower() and one.kinds == {"card": 3, "email": 2, "phone": 2}
    other = pseudonyms.pseudonymise(df, "another key").filter("doc_id = 2").first()
    assert other.text != two.text


def test_look_alikes_stay(spark):
    kept = ["9807915762804490", "300.1.1.1", "2021-02-29", "31.04.2020", "0000-01-01", "666-12-1234", "000-12-1234",
            "123-00-1234", "123-45-0000", "12345", "version 3.0", "1.2.3.4.5", "f" * 40, "12" * 20, "a@b", "99-99"]
    df = spark.createDataFrame([(i, v, None, None) for i, v in enumerate(kept)], SCHEMA)
    for r in pseudonyms.digest(df).collect():
        assert (r.text, r.n_values) == (kept[r.doc_id], 0)


def test_cards_among_other_digits(spark):
    card, amex = "4111 1111 1111 1111", "3782 822463 10005"
    hidden = [(f"{card} 12/25", [card]), (f"2021 {card}", [card]), (f"{card} 12/05/2021", [card]), (f"{card} 737", [card]),
              (f"12 {amex} 4", [amex]), (f"1 2 3 {card.replace(' ', '-')} 4 5", [card.replace(" ", "-")]),
              (f"{card} {amex}", [card, amex]), (f"{card} 5500-0000-0000-0004 17", [card, "5500-0000-0000-0004"]),
              (f"7 4111111111111111 {'1 ' * 5000}", ["4111111111111111"]), (f"{card} 2021-02-03", [card]),
              (f"{card} 123-45-6789", [card]), (f"{card} 123 456 7890", [card])]
    df = spark.createDataFrame([(i, t, None, None) for i, (t, _) in enumerate(hidden)] + [(99, f"{card} {amex}", None, None)], SCHEMA)
    rows = {r.doc_id: r for r in pseudonyms.digest(df).collect()}
    pure = rows[99].text
    for i, (text, cards) in enumerate(hidden):
        got = rows[i]
        assert got.kinds["card"] == len(cards), (text[:60], got.kinds)
        assert len(got.text) == len(text) and all(c not in got.text for c in cards)
        assert re.sub("[0-9]", "0", got.text) == re.sub("[0-9]", "0", text)
        if text.startswith("2021") or "/25" in text:
            assert got.text == text.replace(card, pure[:19])
    assert [rows[i].n_values for i in (2, 9, 10, 11)] == [2, 2, 2, 2]
    assert len({rows[i].text for i in (9, 10, 11)} & {hidden[i][0] for i in (9, 10, 11)}) == 0


def test_dates_with_the_month_first_and_short_parts(spark):
    days = [dt.date(2021, 1, 1) + dt.timedelta(i) for i in range(1461)]
    days += [dt.date(y, 1, 1) + dt.timedelta(i) for y in (1850, 1852) for i in range(365)]
    late = [d.strftime("%m/%d/%Y") for d in days if d.day > 12]
    short = ["7/4/2021", "1.12.1990", "7/25/2021", "07/04/2021"]
    cases = late + short + [d.strftime("%d/%m/%Y") for d in days]
    df = spark.createDataFrame([(i, f"on {v}, ", None, None) for i, v in enumerate(cases)], SCHEMA)
    new = {cases[r.doc_id]: r.text[3:-2] for r in pseudonyms.digest(df).collect() if r.kinds == {"date": 1}}
    assert set(new) == set(cases)
    for v in late:
        month, day, year = map(int, new[v].split("/"))
        assert day > 12 and dt.date(year, month, day) and len(new[v]) == 10
        assert year == int(v[-4:]) or int(v[-4:]) >= 1901
    padded = set(late) | {d.strftime("%d/%m/%Y") for d in days}
    assert len({new[v] for v in padded}) == len(padded)
    assert [int(x) for x in new["7/4/2021"].split("/")] == [int(x) for x in new["07/04/2021"].split("/")]
    assert "." in new["1.12.1990"] and all(not re.search(r"(^|[/.])0", new[v]) for v in short[:3])
    assert int(new["7/25/2021"].split("/")[1]) > 12
    kept = ["13/13/2021", "0/4/2021", "2/30/2021", "31/2/2021", "1/2/0000"]
    same = spark.createDataFrame([(i, v, None, None) for i, v in enumerate(kept)], SCHEMA)
    assert all((r.text, r.n_values) == (kept[r.doc_id], 0) for r in pseudonyms.digest(same).collect())


def test_awkward_rows(spark):
    df = awkward(spark, extra="kind value")
    out = pseudonyms.pseudonymise(df)
    assert out.columns == df.columns + ["n_values", "kinds"]
    same = lambda d: sorted(map(str, d.select("doc_id", "text", "lang", "source").collect()))
    assert same(out) == same(df) and out.filter("n_values > 0").count() == 0
    assert pseudonyms.digest(spark.createDataFrame([], SCHEMA)).collect() == []
    edge = spark.createDataFrame([(1, "1.2.3.4", None, None), (2, "1.2.3.4 1.2.3.4", None, None),
                                  (3, ("x " * 20000) + "1.2.3.4\n", None, None)], SCHEMA)
    got = {r.doc_id: r for r in pseudonyms.digest(edge).collect()}
    ip = got[1].text
    assert got[2].text == f"{ip} {ip}" and got[2].n_values == 2 and got[3].text == ("x " * 20000) + ip + "\n"
    clash = pseudonyms.pseudonymise(awkward(spark, extra="kinds _new"))
    assert clash.columns == ["doc_id", "text", "lang", "source", "_new", "n_values", "kinds"]
    assert clash.filter("_new = 1 and size(kinds) = 0").count() == 14


def test_other_text_is_untouched(spark):
    rows = random_docs(100, 8)
    df = spark.createDataFrame(rows, SCHEMA)
    assert {r.doc_id: r.text for r in pseudonyms.digest(df).collect()} == {r[0]: r[1] for r in rows}


def test_number_tables_are_no_cards(spark):
    """Rows of random digit groups: one in ten windows passes the Luhn digit, hardly any is a card."""
    r = random.Random(6)
    groups = [str(r.randrange(10 ** r.randint(1, 4))) for _ in range(20_000)]
    text = "\n".join(" ".join(groups[i:i + 200]) for i in range(0, len(groups), 200))
    rows = [(0, text), (1, "ref 77 4111 1111 1111 1111 12 5 and more")]
    kinds = {x.doc_id: x.kinds for x in pseudonyms.digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert kinds[0].get("card", 0) < len(groups) / 1000 and kinds[1]["card"] == 1
