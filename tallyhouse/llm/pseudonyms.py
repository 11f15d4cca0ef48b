"""Format-preserving pseudonyms for personal numbers and dates by keyed Feistel permutations.

Every validated value is replaced by another value of the same format: a Feistel network keyed
by a secret permutes the values of its format, so equal values get equal pseudonyms in all
documents (they stay linked, however they are spaced or punctuated), different values never
collide, and the owner of the key could invert it. Punctuation, spacing and letter case of the
original are kept.

Kinds, and what is permuted:

* ``email``: letters among letters and digits among digits of the local part;
* ``ipv4`` (octets 0-255): the pair of 16-bit halves;
* ``date`` (real calendar days; year-month-day, or day and month before the year, each of one
  or two digits, with the month second; where that is no calendar day, with the month first):
  days from 1901 to 2096 as (four-year cycle, day of cycle), others by day of their year. Dates
  with the month first all have days after the 12th and are permuted among these, so that their
  pseudonyms read in no other order. Where a part has one digit the pseudonym is not padded;
* ``ssn`` (area 001-899 but 666, group 01-99, serial 0001-9999): (area, group and serial);
* ``phone`` (8 to 15 digits with a leading +, or 10 digits grouped 3-3-4): all digits after the
  country code;
* ``card`` (13 to 19 digits with a valid Luhn digit): all digits but the last, which is computed;
  cards are also sought among other digit groups (a year before, an expiry date behind);
* ``hex`` (32, 40 or 64 hexadecimal digits with both kinds): digits among digits, letters among
  a-f.

Numbers that look alike but fail their check are left as they are.

Everything is an expression on the row: no shuffle, no collected values, and a text is cut only
at its matches. The round function is SHA-256 of key, kind, tweak, round and the other half.

Defined results: null texts stay null with no values; empty texts stay empty; repeated rows get
the same pseudonyms; an empty table gives no rows; other columns pass through, but for those
named like an added column, which it replaces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import sheltered

ROUNDS = 8
PIECE = 12          # characters permuted together; longer strings are chained piece by piece
KEY = "set a secret key in production"

KINDS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._+-]{0,63}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}",
    "ipv4": r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])",
    "date": r"(?<![0-9/.-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}[/.][0-9]{1,2}[/.][0-9]{4})(?![0-9]|[/.-][0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "phone": r"(?<![0-9+])(?:\+[0-9]{1,3}(?:[ .-]?\(?[0-9]{2,4}\)?){2,4}|\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4})(?![0-9])",
    "card": r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])",
    "hex": r"(?<![A-Za-z0-9])(?:[0-9A-Fa-f]{64}|[0-9A-Fa-f]{40}|[0-9A-Fa-f]{32})(?![A-Za-z0-9])",
}
# digit groups of 13 digits or more, up to a group where a value of another kind begins
_GAP = rf"[ -](?!{'|'.join(v for k, v in KINDS.items() if k != 'card')})"
RUN = rf"(?<![0-9])(?=[0-9](?:(?:{_GAP})?[0-9]){{12}})[0-9]++(?:{_GAP}[0-9]++)*+"
ANY = "|".join([*(v for k, v in KINDS.items() if k not in ("card", "hex")), RUN, KINDS["card"], KINDS["hex"]])
# usual cards: how an issuer's numbers begin, in four groups of four, as 4-6-5 or ungrouped
USUAL = (r"^(?=[456]|3[0-9]|2[2-7])(?:[0-9]{4}([ -]?)[0-9]{4}\1[0-9]{4}\1[0-9]{4}|[0-9]{4}([ -]?)[0-9]{6}\2[0-9]{5}|[0-9]{13,19})$")


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _round(key: str, kind: Column, tweak: Column, r: Column, half: Column, side: Column) -> Column:
    text = F.concat_ws("|", F.lit(key), kind, tweak, r.cast("string"), half.cast("string"))
    number = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 15), 16, 10).cast("long")
    return F.pmod(number, side)


def feistel(left: Column, right: Column, a: Column, b: Column, kind: Column, tweak: Column, key: str) -> Column:
    """struct(l, r): a keyed permutation of the pairs left < a, right < b."""
    def one(s: Column, r: Column) -> Column:
        even = F.pmod(r, F.lit(2)) == 0
        new_l = F.pmod(s["l"] + _round(key, kind, tweak, r, s["r"], a), a)
        new_r = F.pmod(s["r"] + _round(key, kind, tweak, r, s["l"], b), b)
        return F.struct(F.when(even, new_l).otherwise(s["l"]).alias("l"),
                        F.when(even, s["r"]).otherwise(new_r).alias("r"))

    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, one)


def _power(radix: int, n: Column) -> Column:
    return F.element_at(F.array(*[F.lit(radix ** i).cast("long") for i in range(PIECE // 2 + 1)]), n + 1)


def permute_string(s: Column, alphabet: str, kind: Column, key: str) -> Column:
    """``s`` (characters of ``alphabet``) as another string of its length. Pieces of PIECE
    characters are permuted in turn, each under the original text before it as tweak."""
    radix = len(alphabet)
    digits = "0123456789abcdefghijklmnopqrstuvwxyz"[:radix]

    def number(x: Column) -> Column:
        return F.when(x == "", F.lit(0).cast("long")).otherwise(
            F.conv(F.translate(x, alphabet, digits), radix, 10).cast("long"))

    def string(n: Column, width: Column) -> Column:
        raw = F.lower(F.conv(n.cast("string"), 10, radix))
        padded = F.concat(F.substring(F.lit("0" * PIECE), F.lit(1), width - F.length(raw)), raw)
        return F.when(width == 0, F.lit("")).otherwise(F.translate(padded, digits, alphabet))

    def piece(done: Column, i: Column) -> Column:
        def halves(x: Column) -> Column:
            u = F.floor(F.length(x) / 2).cast("int")
            v = F.length(x) - u
            pair = feistel(number(F.substring(x, F.lit(1), u)), number(F.substring(x, u + 1, v)),
                           _power(radix, u), _power(radix, v), kind, tweak, key)
            return let(pair, lambda p: F.concat(string(p["l"], u), string(p["r"], v)))

        tweak = F.concat_ws("|", F.length(s).cast("string"), F.substring(s, F.lit(1), i * PIECE))
        return F.concat(done, let(F.substring(s, i * PIECE + 1, F.lit(PIECE)), halves))

    last = F.floor((F.length(s) - 1) / PIECE).cast("int")
    return F.when(F.length(s) == 0, s).otherwise(
        F.aggregate(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), F.lit(""), piece))


def refill(template: Column, digits: Column, letters: Column | None = None) -> Column:
    """``template`` with its digits (and letters, keeping case) replaced in order."""
    chars = F.filter(F.split(template, ""), lambda c: c != "")
    start = F.struct(F.lit("").alias("o"), F.lit(0).alias("d"), F.lit(0).alias("l"))

    def put(s: Column, c: Column) -> Column:
        is_d, is_l = c.rlike("[0-9]"), c.rlike("[A-Za-z]") & F.lit(letters is not None)
        new = F.when(is_d, F.substring(digits, s["d"] + 1, F.lit(1)))
        if letters is not None:
            low = F.substring(letters, s["l"] + 1, F.lit(1))
            new = new.when(is_l, F.when(c.rlike("[A-Z]"), F.upper(low)).otherwise(low))
        return F.struct(F.concat(s["o"], new.otherwise(c)).alias("o"),
                        (s["d"] + F.when(is_d, 1).otherwise(0)).alias("d"),
                        (s["l"] + F.when(is_l, 1).otherwise(0)).alias("l"))

    return F.aggregate(chars, start, put, lambda s: s["o"])


def _only(x: Column, keep: str) -> Column:
    return F.regexp_replace(x, f"[^{keep}]", "")


def luhn_sum(digits: Column, odd: int) -> Column:
    """Luhn sum of a digit string; digits at odd (1) or even (0) distance from the end double."""
    chars = F.reverse(F.filter(F.split(digits, ""), lambda c: c != ""))

    def weight(c: Column, i: Column) -> Column:
        d = c.cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when(F.pmod(i, F.lit(2)) == odd, twice).otherwise(d)

    return F.aggregate(F.transform(chars, weight), F.lit(0), lambda a, x: a + x)


def _pad(n: Column, width: int) -> Column:
    return F.lpad(n.cast("string"), width, "0")


def _card(m: Column, key: str) -> Column:
    def with_check(digits: Column) -> Column:
        head = permute_string(F.substring(digits, F.lit(1), F.length(digits) - 1), "0123456789", F.lit("card"), key)
        whole = let(head, lambda h: F.concat(h, F.pmod(
            10 - F.pmod(luhn_sum(h, 0), F.lit(10)), F.lit(10)).cast("string")))
        return F.when(F.pmod(luhn_sum(digits, 1), F.lit(10)) == 0, let(whole, lambda w: refill(m, w)))

    return let(_only(m, "0-9"), with_check)


def pieces(m: Column) -> Column:
    """A match in pieces: what stands before a card, the card, and so on, ending with what stands
    behind the last; a match that holds no card among other digit groups is one piece.

    A run of 13 to 19 digits that is a card stays whole. Otherwise every row of whole groups that is
    written as a usual card (USUAL) and has a valid Luhn digit is a candidate: longer ones go first,
    then those further left; those that overlap a card taken already are dropped. Other rows of
    groups inside a longer run are no cards: one in ten would pass the Luhn digit by chance."""
    def cards(tokens: Column) -> Column:
        groups = F.floor((F.size(tokens) + 1) / 2).cast("int")

        def at(i: Column) -> Column:
            def one(j: Column) -> Column:
                text = F.array_join(F.slice(tokens, 2 * i + 1, 2 * (j - i) + 1), "")
                return let(text, lambda t: F.struct(
                    (-F.length(_only(t, "0-9"))).alias("less"), i.alias("i"), j.alias("j"), t.alias("card")))

            return F.transform(F.sequence(i, F.least(i + 18, groups - 1)), one)

        found = F.filter(F.flatten(F.transform(F.sequence(F.lit(0), groups - 1), at)), lambda c: F.when(
            c["less"].between(-19, -13) & c["card"].rlike(USUAL), F.pmod(luhn_sum(_only(c["card"], "0-9"), 1), F.lit(10)) == 0).otherwise(False))
        none = F.filter(found, lambda c: F.lit(False))
        taken = F.aggregate(F.array_sort(found), none, lambda done, c: F.when(
            F.exists(done, lambda d: (d["i"] <= c["j"]) & (c["i"] <= d["j"])), done).otherwise(F.concat(done, F.array(c))))
        return F.array_sort(F.transform(taken, lambda c: F.struct(c["i"].alias("i"), c["j"].alias("j"), c["card"].alias("card"))))

    def cut(tokens: Column, found: Column) -> Column:
        def one(t: Column) -> Column:
            start = F.when(t > 0, 2 * F.get(found, t - 1)["j"] + 1).otherwise(0)
            end = F.when(t < F.size(found), 2 * F.get(found, t)["i"]).otherwise(F.size(tokens))
            rest = F.array_join(F.slice(tokens, start + 1, end - start), "")
            return F.when(t < F.size(found), F.array(rest, F.get(found, t)["card"])).otherwise(F.array(rest))

        return F.flatten(F.transform(F.sequence(F.lit(0), F.size(found)), one))

    digits = _only(m, "0-9")
    whole = F.length(digits).between(13, 19) & (F.pmod(luhn_sum(digits, 1), F.lit(10)) == 0)
    several = let(F.regexp_extract_all(m, F.lit("[0-9]+|[ -]"), F.lit(0)), lambda t: let(cards(t), lambda c: cut(t, c)))
    return F.when(m.rlike("^[0-9][0-9 -]{12,}$"), F.when(whole, F.array(m)).otherwise(several)).otherwise(F.array(m))


def _ssn(m: Column, key: str) -> Column:
    area, group, serial = (F.substring(m, p, n).cast("int") for p, n in ((1, 3), (5, 2), (8, 4)))
    ok = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    index = area - F.when(area > 666, 2).otherwise(1)
    pair = feistel(index, (group - 1) * 9999 + serial - 1, F.lit(898).cast("long"), F.lit(99 * 9999).cast("long"),
                   F.lit("ssn"), F.lit(""), key)

    def text(p: Column) -> Column:
        rest = F.pmod(p["r"], F.lit(9999))
        return F.concat_ws("-", _pad(p["l"] + F.when(p["l"] >= 665, 2).otherwise(1), 3),
                           _pad(((p["r"] - rest) / 9999 + 1).cast("int"), 2), _pad(rest + 1, 4))

    return F.when(ok, let(pair, text))


def _ipv4(m: Column, key: str) -> Column:
    def text(p: Column) -> Column:
        low = {h: F.pmod(p[h], F.lit(256)) for h in "lr"}
        cells = [x.cast("int") for h in "lr" for x in ((p[h] - low[h]) / 256, low[h])]
        return F.concat_ws(".", *[c.cast("string") for c in cells])

    def value(o: Column) -> Column:
        octet = [F.get(o, F.lit(i)) for i in range(4)]
        pair = feistel(octet[0] * 256 + octet[1], octet[2] * 256 + octet[3], F.lit(65536).cast("long"),
                       F.lit(65536).cast("long"), F.lit("ipv4"), F.lit(""), key)
        return F.when(F.array_max(o) < 256, let(pair, text))

    return let(F.split(m, "[.]").cast("array<int>"), value)


# days before each month of a four-year cycle (its last year has the leap day) and of one year
_LENGTHS = [31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31]
_CYCLE = [n + (i == 37) for i, n in enumerate(_LENGTHS * 4)]
_LEAP = [n + (i == 1) for i, n in enumerate(_LENGTHS)]
EARLY = 12          # days of a month that could be a month's number


def _late(lengths: list[int]) -> tuple[Column, int]:
    """For each month the days after the EARLYth before it, and their number in all."""
    before = [sum(lengths[:i]) - EARLY * i for i in range(len(lengths) + 1)]
    return F.array(*[F.lit(n) for n in before[:-1]]), before[-1]


def _date(m: Column, key: str) -> Column:
    iso = m.rlike(r"^[0-9]{4}-")
    first, last = F.lit("1901-01-01").cast("date"), F.lit("2096-12-31").cast("date")
    (cycle, many), (leap, some), (common, fewer) = _late(_CYCLE), _late(_LEAP), _late(_LENGTHS)

    def day_of(late: Column, before: Column) -> Column:
        """From the number of a day among the late ones, its number among all."""
        return late + EARLY * F.size(F.filter(before, lambda n: n <= late))

    def permuted(day: Column) -> Column:
        n = F.datediff(day, first)
        b = F.pmod(n, F.lit(1461))
        wide = feistel((n - b) / 1461, b, F.lit(49).cast("long"), F.lit(1461).cast("long"),
                       F.lit("date"), F.lit(""), key)
        year = F.trunc(day, "year")
        near = feistel(F.lit(0), F.datediff(day, year), F.lit(1).cast("long"),
                       F.datediff(F.add_months(year, 12), year).cast("long"), F.lit("date"),
                       F.year(day).cast("string"), key)
        return F.when(day.between(first, last), let(wide, lambda w: F.date_add(
            first, (w["l"] * 1461 + w["r"]).cast("int")))).otherwise(
                let(near, lambda w: F.date_add(year, w["r"].cast("int"))))

    def permuted_late(day: Column) -> Column:
        n = F.datediff(day, first)
        b = F.pmod(n, F.lit(1461))
        months = F.pmod(F.year(day) - 1901, F.lit(4)) * 12 + F.month(day)
        wide = feistel((n - b) / 1461, b - EARLY * months, F.lit(49).cast("long"), F.lit(many).cast("long"),
                       F.lit("date, month first"), F.lit(""), key)
        year = F.trunc(day, "year")
        is_leap = F.datediff(F.add_months(year, 12), year) == 366
        near = feistel(F.lit(0), F.datediff(day, year) - EARLY * F.month(day), F.lit(1).cast("long"),
                       F.when(is_leap, some).otherwise(fewer).cast("long"), F.lit("date, month first"),
                       F.year(day).cast("string"), key)
        return F.when(day.between(first, last), let(wide, lambda w: F.date_add(
            first, (w["l"] * 1461 + day_of(w["r"], cycle)).cast("int")))).otherwise(
                let(near, lambda w: F.date_add(year, F.when(is_leap, day_of(w["r"], leap)).otherwise(
                    day_of(w["r"], common)).cast("int"))))

    def written(d: Column, month_first: bool) -> Column:
        one, two = (F.month(d), F.dayofmonth(d)) if month_first else (F.dayofmonth(d), F.month(d))
        width = F.when(m.rlike(r"^[0-9]{1,2}[/.][0-9]{1,2}[/.]") & ~m.rlike(r"^[0-9]{2}[/.][0-9]{2}[/.]"), 1).otherwise(2)
        parts = [F.when((width == 2) & (x < 10), F.concat(F.lit("0"), x.cast("string"))).otherwise(x.cast("string"))
                 for x in (one, two)]
        marks = [F.regexp_extract(m, r"^[0-9]+([/.])[0-9]+([/.])", i) for i in (1, 2)]
        return F.concat(parts[0], marks[0], parts[1], marks[1], _pad(F.year(d), 4))

    def real(year: Column, month: Column, day: Column) -> Column:
        text = F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0"))
        return F.when(year != "0000", text.try_cast("date"))

    part = [F.regexp_extract(m, r"^([0-9]{1,2})[/.]([0-9]{1,2})[/.]([0-9]{4})$", i) for i in (1, 2, 3)]
    iso_day = F.when(F.substring(m, 1, 4) != "0000", m.try_cast("date"))
    in_iso = let(iso_day, lambda day: F.when(day.isNotNull(), let(
        permuted(day), lambda d: refill(m, F.date_format(d, "yyyyMMdd")))))
    day_first = let(real(part[2], part[1], part[0]), lambda day: F.when(day.isNotNull(), let(
        permuted(day), lambda d: written(d, False))))
    month_first = let(real(part[2], part[0], part[1]), lambda day: F.when(day.isNotNull(), let(
        permuted_late(day), lambda d: written(d, True))))
    return F.when(iso, in_iso).otherwise(F.coalesce(day_first, month_first))


def _phone(m: Column, key: str) -> Column:
    plus = m.startswith("+")
    code = F.when(plus, F.regexp_extract(m, r"^\+([0-9]{1,3})(?=[^0-9])", 1)).otherwise(F.lit(""))
    # without a separator the code's length is unknown: its first digit stays
    code = F.when(plus & (code == ""), F.substring(m, 2, 1)).otherwise(code)

    def value(c: Column, digits: Column) -> Column:
        new = permute_string(F.substring(digits, F.length(c) + 1, F.length(digits)), "0123456789",
                             F.concat(F.lit("phone"), c), key)
        return F.when(F.length(digits).between(8, 15), let(new, lambda n: refill(m, F.concat(c, n))))

    return let(code, lambda c: let(_only(m, "0-9"), lambda d: value(c, d)))


def _mixed(text: Column, kind: Column, letters: str, key: str) -> Column:
    """Letters of ``text`` permuted among ``letters`` and digits among digits; where they stand
    and the other class are part of the tweak."""
    shape = F.regexp_replace(F.regexp_replace(text, "[A-Za-z]", "a"), "[0-9]", "0")

    def value(tag: Column, d: Column) -> Column:
        new_l = permute_string(F.lower(_only(text, "A-Za-z")), letters, F.concat_ws("|", tag, d), key)

        def last(x: Column) -> Column:
            new_d = permute_string(d, "0123456789", F.concat_ws("|", tag, x), key)
            return let(new_d, lambda n: refill(text, n, x))

        return let(new_l, last)

    return let(F.concat_ws("|", kind, shape), lambda tag: let(_only(text, "0-9"), lambda d: value(tag, d)))


def _email(m: Column, key: str) -> Column:
    local, domain = F.regexp_extract(m, "^([^@]*)(@.*)$", 1), F.regexp_extract(m, "^([^@]*)(@.*)$", 2)
    kind = F.concat_ws("|", F.lit("email"), F.lower(domain))
    return F.concat(let(local, lambda t: _mixed(t, kind, "abcdefghijklmnopqrstuvwxyz", key)), domain)


def _hex(m: Column, key: str) -> Column:
    return F.when(m.rlike("[0-9]") & m.rlike("[A-Fa-f]"), _mixed(m, F.lit("hex"), "abcdef", key))


PSEUDONYM = {"email": _email, "ipv4": _ipv4, "date": _date, "ssn": _ssn, "phone": _phone, "card": _card, "hex": _hex}


def pseudonym(m: Column, key: str = KEY) -> Column:
    """struct(kind, value) for one matched string; nulls if no kind's check holds."""
    tries = F.array(*[F.when(m.rlike(f"^(?:{KINDS[k]})$"), f(m, key)) for k, f in PSEUDONYM.items()])

    def pick(t: Column) -> Column:
        values = [F.get(t, F.lit(i)) for i in range(len(PSEUDONYM))]
        kind = F.coalesce(*[F.when(v.isNotNull(), F.lit(k)) for k, v in zip(PSEUDONYM, values)])
        return F.struct(kind.alias("kind"), F.coalesce(*values).alias("value"))

    return let(tries, pick)


def pseudonymise(documents: DataFrame, key: str = KEY) -> DataFrame:
    """``documents`` with personal numbers and dates of ``text`` replaced, n_values (how many)
    and kinds (map from kind to count)."""
    return sheltered(documents, ("text",), lambda rows: _pseudonymise(rows, key))


def _pseudonymise(documents: DataFrame, key: str) -> DataFrame:
    some = F.coalesce(F.col("text").rlike(ANY), F.lit(False))
    marked = documents.withColumn("_found", F.when(some, F.regexp_extract_all("text", F.lit(ANY), F.lit(0)))
                                  .otherwise(F.array().cast("array<string>")))
    new = F.transform("_found", lambda m: F.transform(pieces(m), lambda x: F.struct(
        x.alias("piece"), pseudonym(x, key).alias("new"))))
    valid = marked.withColumn("_new", F.when(F.size("_found") > 0, new))
    value = F.transform("_new", lambda m: F.array_join(
        F.transform(m, lambda p: F.coalesce(p["new"]["value"], p["piece"])), ""))
    joined = F.array_join(F.flatten(F.zip_with(F.split("text", ANY, -1), value,
                                               lambda a, b: F.array(a, F.coalesce(b, F.lit(""))))), "")
    done = F.filter(F.transform(F.flatten("_new"), lambda p: p["new"]["kind"]), lambda k: k.isNotNull())
    counts = F.map_from_entries(F.transform(F.array_distinct(done), lambda k: F.struct(
        k, F.size(F.filter(done, lambda x: x == k)).alias("n"))))
    none = F.create_map().cast("map<string,int>")
    has = F.col("_new").isNotNull()
    return (valid.withColumn("text", F.when(has, joined).otherwise(F.col("text")))
            .withColumn("n_values", F.when(has, F.size(done)).otherwise(0))
            .withColumn("kinds", F.when(has, counts).otherwise(none)).drop("_found", "_new"))


def digest(documents: DataFrame) -> DataFrame:
    """The query: doc_id, n_values, kinds and the text with pseudonyms."""
    return pseudonymise(documents.select("doc_id", "text")).select("doc_id", "n_values", "kinds", "text")
