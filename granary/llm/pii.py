"""PII: format-preserving Feistel pseudonyms, in DataFrame functions only.

Personal values are found by their shape and validated (check digits, calendar, ranges); a valid one is replaced by a
keyed permutation of the values of its own format: cards stay valid cards of the same length and first digit, dates
stay dates of the calendar from 1900 to 2099, separators stay where they are. A value is written as a vector of symbols,
each with its own radix, which is cut in two; in each round one half is shifted by a keyed hash of the other, so equal
values get equal pseudonyms in every document, different ones different pseudonyms, and the key alone undoes it.
Values may be of any length; the work grows with it in proportion.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.llm import common

ROUNDS = 8
#: Days from 1900-01-01 to 2099-12-31, and the two radices whose product is the smallest that holds them.
DAYS, DAY_HIGH, DAY_LOW = 73_049, 271, 270

#: What says that a secret follows; it is part of the match and stays as it is.
_NAMED = r"passwords?|passwd|pass[-_ ]?phrase|pwd|secret"
_GIVEN = rf"(?i:{_NAMED}|(?<![a-z])pw|token|api[_-]?key|access[_-]?key)[\"']?(?:\s{{0,2}}[=:]\s{{0,2}}|\s{{1,2}}is:?\s{{1,2}})[\"']?"
#: A secret: 7 or more characters up to white space, a quote or an angle bracket, without punctuation at the end, with a letter and a digit.
_SECRET = r"(?=[^\s\"'<>]*[A-Za-z])(?=[^\s\"'<>]*[0-9])[^\s\"'<>]{6,}[^\s\"'<>.,;:!?)\]}]"
#: After = or : and the name of a password, 12 or more characters are one whatever they are.
_WORDY = rf"(?i:{_NAMED})[\"']?\s{{0,2}}[=:]\s{{0,2}}[\"']?[^\s\"'<>]{{11,}}[^\s\"'<>.,;:!?)\]}}]"
#: Tokens that say themselves what they are; the part before the last sign of it stays.
_SHORT_PREFIX = r"(?:gh[opsur]_|github_pat_|glpat-|xox[abeoprs]-|[rs]k_(?:live|test)_|sk-(?:[a-z]{2,5}-)?|AIza|ya29\.)"
_BEARER, _PEM = r"(?i:bearer)\s{1,2}", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"
_PREFIX = rf"(?:{_SHORT_PREFIX}|eyJ|{_BEARER}|{_PEM})"
#: How personal values look. Which of them a match is, and whether it is valid, is decided afterwards.
SHAPES = {
    "email": r"(?<![\w.%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "key": r"(?<![\w])AKIA[0-9A-Z]{16}(?![\w])",
    "secret": f"{_GIVEN}{_SECRET}|{_WORDY}",
    "token": rf"(?<![\w])(?:{_SHORT_PREFIX}[A-Za-z0-9_-]{{16,}}|eyJ[A-Za-z0-9_-]{{6,}}(?:\.[A-Za-z0-9_-]{{6,}}){{1,2}}|{_BEARER}(?!eyJ)(?=[^\s]*[0-9])[A-Za-z0-9._~+/-]{{16,}}=*)|{_PEM}\s[A-Za-z0-9+/=\s]{{16,}}",
    "iban": r"(?<![\w])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![\w])",
    "phone": r"(?<![\w+])\+[0-9]{1,3}[ .-]?\(?[0-9]{1,4}\)?(?:[ .-]?[0-9]{2,4}){2,4}(?![\w])|(?<![\w(])\([2-9][0-9]{2}\) ?[0-9]{3}[ .-][0-9]{4}(?![\w])"
    r"|(?<![\w.-])[2-9][0-9]{2}([-.])[2-9][0-9]{2}\1[0-9]{4}(?![\w-])",
    "date": r"(?<![\w/.-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{4}/[0-9]{2}/[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?![\w/-])",
    "ssn": r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])",
    "ip": r"(?<![\w.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![\w]|\.[0-9])",
    "card": r"(?<![\w.+-])(?:[0-9](?:[ -]?[0-9]){12,18}(?![\w]|-[0-9])|[0-9]{4}(?:\.[0-9]{4}){3}(?![\w]|[.-][0-9]))",
}
_ANY = "|".join(SHAPES.values())


def _chars(s: Column) -> Column:
    return F.filter(F.split(s, "(?s)(?<=.)(?=.)"), lambda c: c != "")


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _join(symbols: Column) -> Column:
    return F.array_join(F.transform(symbols, lambda x: x.cast("string")), "")


def _luhn(digits: Column) -> Column:
    """The sum of a digit string, every second digit from the last but one on doubled. Valid: divisible by ten."""
    n = F.length(digits)
    doubled = F.transform(_chars(digits), lambda c, i: F.when((n - i) % 2 == 0, (c.cast("int") * 2) % 10 + F.floor(c.cast("int") * 2 / 10).cast("int")).otherwise(c.cast("int")))
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x)


def _mod97(s: Column) -> Column:
    """A string of digits and capital letters (A is 10) as a number, modulo 97."""
    value = lambda c: F.when(c.rlike("[0-9]"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
    return F.aggregate(_chars(s), F.lit(0), lambda a, c: (a * F.when(c.rlike("[0-9]"), 10).otherwise(100) + value(c)) % 97)


def _day(s: Column) -> Column:
    """The date of a match, or null: yyyy-mm-dd, yyyy/mm/dd, dd/mm/yyyy or dd.mm.yyyy."""
    iso = F.when(s.rlike("^[0-9]{4}[-/]"), F.replace(s, F.lit("/"), F.lit("-"))).otherwise(F.concat(F.substr(s, F.lit(7), F.lit(4)), F.lit("-"), F.substr(s, F.lit(4), F.lit(2)), F.lit("-"), F.substr(s, F.lit(1), F.lit(2))))
    day = F.datediff(F.try_to_date(iso, "yyyy-MM-dd"), F.lit("1900-01-01").cast("date"))
    return F.when((day >= 0) & (day < DAYS), day)


def _kind(m: Column) -> Column:
    """What a match is, or null if it isn't valid."""
    whole = lambda shape: m.rlike(f"^(?:{shape})$")
    plain, digits = F.regexp_replace(m, " ", ""), _digits(m)
    iban = F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4)))
    octets = F.split(m, r"\.")
    return (
        F.when(m.rlike(f"^{_GIVEN}"), F.lit("secret"))
        .when(m.rlike(f"^{_PREFIX}"), F.lit("token"))
        .when(m.contains("@"), F.lit("email"))
        .when(whole("AKIA[0-9A-Z]{16}"), F.lit("key"))
        .when(whole(r"[A-Z]{2}[0-9]{2}[A-Z0-9 ]{8,}") & F.length(plain).between(15, 34) & (_mod97(iban) == 1), F.lit("iban"))
        .when(whole(r"[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{4}/[0-9]{2}/[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}"), F.when(_day(m).isNotNull(), F.lit("date")))
        .when(whole("[0-9]{3}-[0-9]{2}-[0-9]{4}"), F.when(m.rlike("^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)"), F.lit("ssn")))
        .when(whole(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}"), F.when(F.forall(octets, lambda o: o.cast("int") <= 255), F.lit("ip")))
        .when(m.rlike(r"^[+(]") | whole(r"[0-9]{3}[-.][0-9]{3}[-.][0-9]{4}"), F.when(F.length(digits).between(8, 15), F.lit("phone")))
        .when(whole(r"[0-9](?:[ -]?[0-9]){12,18}|[0-9]{4}(?:\.[0-9]{4}){3}") & (_luhn(digits) % 10 == 0) & digits.rlike("[1-9]"), F.lit("card"))
    )


def _symbol(value: Column, radix: Column, base: Column) -> Column:
    """value: from 0 to radix - 1; base: what is added to it again in the end."""
    return F.struct(value.cast("int").alias("v"), radix.cast("int").alias("r"), base.cast("int").alias("b"))


def _letters(s: Column, joint: Column) -> Column:
    """Symbols of characters, each kept within its kind: digits, small and capital letters, or (joint) base 16. Others stay."""
    code = F.ascii
    return F.transform(
        _chars(s),
        lambda c: F.when(joint & c.rlike("[0-9]"), _symbol(code(c) - 48, F.lit(16), F.lit(-1)))
        .when(joint, _symbol(code(c) - 87, F.lit(16), F.lit(-1)))
        .when(c.rlike("[0-9]"), _symbol(code(c) - 48, F.lit(10), F.lit(48)))
        .when(c.rlike("[a-z]"), _symbol(code(c) - 97, F.lit(26), F.lit(97)))
        .when(c.rlike("[A-Z]"), _symbol(code(c) - 65, F.lit(26), F.lit(65)))
        .otherwise(_symbol(F.lit(0), F.lit(1), code(c))),
    )


def _unletters(symbols: Column) -> Column:
    hexadecimal = lambda v: F.substr(F.lit("0123456789abcdef"), v + 1, F.lit(1))
    beyond = lambda b: F.decode(F.unhex(F.lpad(F.hex(b), 8, "0")), "UTF-32")
    one = lambda x: F.when(x["b"] == -1, hexadecimal(x["v"])).when(x["b"] > 127, beyond(x["b"])).otherwise(F.char(x["v"] + x["b"]))
    return F.array_join(F.transform(symbols, one), "")


def _kept(m: Column, kind: Column) -> Column:
    """The part of a value, without separators, that stays as it is and goes into the hash: its format."""
    digits, plain = _digits(m), F.regexp_replace(m, " ", "")
    return (
        F.when(kind == "email", F.regexp_extract(m, "@.*$", 0))
        .when(kind == "key", F.lit("AKIA"))
        .when(kind == "token", F.regexp_extract(m, f"^{_PREFIX}", 0))
        .when(kind == "iban", F.substr(plain, F.lit(1), F.lit(2)))
        .when(kind == "card", F.substr(digits, F.lit(1), F.lit(1)))
        .when((kind == "phone") & m.startswith("+1"), F.lit("1"))
        .when((kind == "phone") & m.startswith("+"), F.substr(digits, F.lit(1), F.lit(2)))
        .otherwise(F.lit(""))
    )


def _value(m: Column) -> Column:
    """A match without what says that a secret follows."""
    return F.regexp_replace(m, f"^{_GIVEN}", "")


def _symbols(m: Column, kind: Column) -> Column:
    """A value as symbols."""
    digits, plain, kept = _digits(m), F.regexp_replace(m, " ", ""), F.length(_kept(m, kind))
    rest = F.substr(digits, kept + 1)
    american = ~m.startswith("+") | m.startswith("+1")
    number = lambda s: F.transform(_chars(s), lambda c: _symbol(c, F.lit(10), F.lit(0)))
    dialled = F.transform(
        _chars(rest),
        lambda c, i: F.when(american & i.isin(0, 3) & (c >= "2"), _symbol(c.cast("int") - 2, F.lit(8), F.lit(2)))
        .when(american & i.isin(0, 3), _symbol(c, F.lit(2), F.lit(0)))
        .otherwise(_symbol(c, F.lit(10), F.lit(0))),
    )
    area = F.substr(digits, F.lit(1), F.lit(3)).cast("int")
    social = F.array(
        _symbol(F.when(area < 666, area - 1).otherwise(area - 2), F.lit(898), F.lit(0)),
        _symbol(F.substr(digits, F.lit(4), F.lit(2)).cast("int") - 1, F.lit(99), F.lit(0)),
        _symbol(F.substr(digits, F.lit(6), F.lit(4)).cast("int") - 1, F.lit(9999), F.lit(0)),
    )
    address = F.transform(
        F.split(m, r"\."),
        lambda o, i: F.when(i > 0, _symbol(o, F.lit(256), F.lit(0)))
        .when(o.cast("int").between(1, 223), _symbol(o.cast("int") - 1, F.lit(223), F.lit(1)))
        .otherwise(_symbol(F.lit(0), F.lit(1), o.cast("int"))),
    )
    day, secret = _day(m), _value(m)
    return (
        F.when(kind == "email", _letters(F.regexp_extract(m, "^[^@]*", 0), F.lit(False)))
        .when(kind == "key", _letters(F.substr(m, F.lit(5)), F.lit(False)))
        .when(kind == "secret", _letters(secret, secret.rlike("^[0-9a-f]+$")))
        .when(kind == "token", _letters(F.regexp_replace(m, f"^{_PREFIX}", ""), F.lit(False)))
        .when(kind == "iban", _letters(F.substr(plain, F.lit(5)), F.lit(False)))
        .when(kind == "card", number(F.substr(digits, F.lit(2), F.length(digits) - 2)))
        .when(kind == "phone", dialled)
        .when(kind == "ssn", social)
        .when(kind == "ip", address)
        .when(kind == "date", F.array(_symbol(F.floor(day / DAY_LOW), F.lit(DAY_HIGH), F.lit(0)), _symbol(day % DAY_LOW, F.lit(DAY_LOW), F.lit(0))))
    )


def feistel(symbols: Column, key: Column) -> Column:
    """The symbols after ``ROUNDS`` rounds. Halves take turns: each symbol of one is shifted, modulo its radix, by a hash
    of the key, the round, its place and the whole other half."""
    n = F.size(symbols)
    half = F.floor(n / 2).cast("int")

    def turn(now: Column, i: Column) -> Column:
        first = i % 2 == 0
        other = F.array_join(F.transform(F.filter(now, lambda x, j: (j < half) != first), lambda x: x["v"].cast("string")), ",")
        shift = lambda d, j: F.conv(F.substr(F.sha2(F.concat_ws("|", d, j), 256), F.lit(1), F.lit(12)), 16, 10).cast("long")
        moved = lambda d, x, j: F.struct(((x["v"] + shift(d, j)) % x["r"]).cast("int").alias("v"), x["r"].alias("r"), x["b"].alias("b"))
        # The other half is hashed once; a symbol's shift is taken from that and the symbol's place.
        return common.once(
            F.sha2(F.concat_ws("|", key, i, other), 256), lambda d: F.transform(now, lambda x, j: F.when(((j < half) == first) & (x["r"] > 1), moved(d, x, j)).otherwise(x))
        )

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), symbols, turn)


def _walked(symbols: Column, key: Column) -> Column:
    """The permutation of the days: that of all pairs of symbols, taken again while it leads beyond the last day."""
    inside = lambda s: s[0]["v"] * DAY_LOW + s[1]["v"] < DAYS
    again = F.sequence(F.lit(1), F.lit(DAY_HIGH * DAY_LOW - DAYS))
    return F.aggregate(again, feistel(symbols, key), lambda s, _: F.when(inside(s), s).otherwise(feistel(s, key)))


def _fill(m: Column, pattern: str, given: Column) -> Column:
    """``m`` with the characters that match ``pattern`` replaced by those of ``given``, in order."""
    at = lambda i: F.length(F.regexp_replace(F.substr(m, F.lit(1), i + 1), f"(?!{pattern}).", ""))
    return F.array_join(F.transform(_chars(m), lambda c, i: F.when(c.rlike(pattern), F.substr(given, at(i), F.lit(1))).otherwise(c)), "")


def _written(m: Column, kind: Column, symbols: Column) -> Column:
    """The pseudonym, in the format of ``m``."""
    kept = _kept(m, kind)
    values = _join(F.transform(symbols, lambda x: x["v"] + x["b"]))
    first = F.concat(kept, values)
    check = (10 - _luhn(F.concat(first, F.lit("0"))) % 10) % 10
    inner = _unletters(symbols)
    bank = F.concat(kept, F.lpad((98 - _mod97(F.concat(inner, kept, F.lit("00")))).cast("string"), 2, "0"), inner)
    area = symbols[0]["v"]
    social = F.concat(
        F.lpad(F.when(area < 665, area + 1).otherwise(area + 2).cast("string"), 3, "0"), F.lpad((symbols[1]["v"] + 1).cast("string"), 2, "0"),
        F.lpad((symbols[2]["v"] + 1).cast("string"), 4, "0"),
    )
    day = F.date_add(F.lit("1900-01-01").cast("date"), (symbols[0]["v"] * DAY_LOW + symbols[1]["v"]).cast("int"))
    return (
        F.when(kind == "email", F.concat(inner, kept))
        .when(kind.isin("key", "token"), F.concat(kept, inner))
        .when(kind == "secret", F.concat(F.regexp_extract(m, f"^{_GIVEN}", 0), inner))
        .when(kind == "iban", _fill(m, "[A-Z0-9]", bank))
        .when(kind == "card", _fill(m, "[0-9]", F.concat(first, check.cast("string"))))
        .when(kind == "phone", _fill(m, "[0-9]", first))
        .when(kind == "ssn", _fill(m, "[0-9]", social))
        .when(kind == "ip", F.array_join(F.transform(symbols, lambda x: (x["v"] + x["b"]).cast("string")), "."))
        .when(kind == "date", F.when(m.rlike("^[0-9]{4}-"), F.date_format(day, "yyyy-MM-dd")).when(m.rlike("^[0-9]{4}/"), F.date_format(day, "yyyy/MM/dd")).when(m.contains("/"), F.date_format(day, "dd/MM/yyyy")).otherwise(F.date_format(day, "dd.MM.yyyy")))
    )


#: How a card is written that starts inside a longer run of numbers.
_GROUPED = r"^(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5})$"


def _card_span(m: Column) -> Column:
    """struct(start, end): the longest valid card between separators in a run of numbers; all of it if it is valid itself or holds none.

    One that doesn't start the run has to be grouped like a card.
    """
    n = F.length(m)
    apart = lambda i: F.substr(m, i, F.lit(1)).isin(" ", "-")

    def valid(i: Column, j: Column) -> Column:
        own = F.substr(m, i, j - i + 1)
        digits = _digits(own)
        return (F.length(digits) >= 13) & ((i == 1) | own.rlike(_GROUPED)) & (_luhn(digits) % 10 == 0) & digits.rlike("[1-9]")

    starts = F.filter(F.sequence(F.lit(1), n - 12), lambda i: (i == 1) | apart(i - 1))
    ends = lambda i: F.filter(F.sequence(i + 12, n), lambda j: ((j == n) | apart(j + 1)) & valid(i, j))
    found = F.array_max(F.flatten(F.transform(starts, lambda i: F.transform(ends(i), lambda j: F.struct((j - i).alias("long"), (-i).alias("i"), j.alias("j"))))))
    whole = F.struct(F.lit(1).alias("start"), n.alias("end"))
    run = m.rlike("^[0-9](?:[ -]?[0-9]){13,18}$") & m.rlike("[ -]") & (n > 13)
    part = common.once(found, lambda x: F.when(x.isNull(), whole).otherwise(F.struct((-x["i"]).alias("start"), x["j"].alias("end"))))
    return F.when(run, F.when(_kind(m).isNull(), part).otherwise(whole)).otherwise(whole)


def _split(text: Column) -> tuple[Column, Column]:
    """The pieces between matches, and the matches.

    Of a run of numbers that holds a card the card is a match; what stands before it is a match that isn't valid, and
    what follows is searched again.
    """
    hits, gaps = F.regexp_extract_all(text, F.lit(_ANY), F.lit(0)), F.split(text, _ANY, -1)
    spans = F.transform(hits, lambda m, i: F.struct(m.alias("m"), _card_span(m).alias("at"), i.alias("i")))
    none = F.array().cast("array<string>")

    def parted(found: Column, between: Column) -> Column:
        cut = F.transform(
            found,
            lambda x: F.struct(
                F.substr(x["m"], F.lit(1), x["at"]["start"] - 1).alias("before"), F.substr(x["m"], x["at"]["start"], x["at"]["end"] - x["at"]["start"] + 1).alias("m"),
                (x["at"]["end"] < F.length(x["m"])).alias("cut"), F.concat(F.substr(x["m"], x["at"]["end"] + 1), F.get(between, x["i"] + 1)).alias("rest"),
            ),
        )
        ahead = lambda x, this: F.when(x["before"] != "", F.array(this)).otherwise(none)
        again = lambda x: F.when(x["cut"], F.regexp_extract_all(x["rest"], F.lit(_ANY), F.lit(0))).otherwise(none)
        pieces = lambda x: F.when(x["cut"], F.split(x["rest"], _ANY, -1)).otherwise(F.array(x["rest"]))
        first = F.array(F.get(between, F.lit(0)))
        return common.once(
            cut,
            lambda c: F.struct(
                F.concat(first, F.flatten(F.transform(c, lambda x: F.concat(ahead(x, F.lit("")), pieces(x))))).alias("gaps"),
                F.flatten(F.transform(c, lambda x: F.concat(ahead(x, x["before"]), F.array(x["m"]), again(x)))).alias("hits"),
            ),
        )

    whole = common.once(F.struct(spans.alias("spans"), gaps.alias("gaps")), lambda x: parted(x["spans"], x["gaps"]))
    return whole["gaps"], whole["hits"]


def pseudonyms(text: Column, key: str) -> tuple[Column, Column, Column]:
    """For a text: the pieces between matches, the matches, and (value, kind, pseudonym) of each match.

    kind and pseudonym are null for matches that aren't valid.
    """
    gaps, hits = _split(text)
    known = F.transform(hits, lambda m: F.struct(m.alias("value"), _kind(m).alias("kind")))
    coded = F.transform(known, lambda x: F.struct(x["value"].alias("value"), x["kind"].alias("kind"), _symbols(x["value"], x["kind"]).alias("s")))
    tweak = lambda x: F.concat_ws("|", F.lit(key), x["kind"], _kept(x["value"], x["kind"]), F.size(x["s"]))
    moved = F.transform(
        coded,
        lambda x: F.struct(
            x["value"].alias("value"), x["kind"].alias("kind"),
            F.when(x["kind"] == "date", _walked(x["s"], tweak(x))).when(x["kind"].isNotNull(), feistel(x["s"], tweak(x))).alias("s"),
        ),
    )
    written = F.transform(
        moved, lambda x: F.struct(x["value"].alias("value"), x["kind"].alias("kind"), F.when(x["kind"].isNotNull(), _written(x["value"], x["kind"], x["s"])).alias("pseudonym"))
    )
    return gaps, hits, written


def pseudonymised(docs: DataFrame, key: str, column: str = "text", found: str | None = None) -> DataFrame:
    """``docs`` with the personal values of ``column`` replaced; all columns stay, and no row is added or lost.

    key: what the permutations depend on; keep it secret. E-mail addresses (the part before the @), phone numbers,
    payment cards, bank accounts, social security numbers, IPv4 addresses, calendar dates, access keys, private keys, web
    tokens, and passwords and tokens that are given as such, of any length and characters. Equal values get
    equal pseudonyms, whatever separates their digits; a value never becomes one of another format. Texts without valid
    values, null and empty texts are unchanged to the letter. found: the name of a column to add, with an array of
    (kind, pseudonym) of what was replaced, in order (empty for null texts). Empty table: no rows.
    """
    at = common.fresh(docs, "__pii")
    text = F.col(f"`{column}`").cast("string")
    if not key:
        raise ValueError("a key is needed")
    seen = text.rlike(f"[0-9@]|(?i:{_NAMED})")
    gaps, _, written = pseudonyms(text, key)
    whole = docs.withColumn(at, F.when(seen, F.struct(gaps.alias("gaps"), written.alias("hits"))))
    hits = F.col(f"{at}.hits")
    rest = F.transform(hits, lambda x, i: F.concat(F.coalesce(x["pseudonym"], x["value"]), F.get(F.col(f"{at}.gaps"), i + 1)))
    replaced = F.when(F.size(hits) > 0, F.concat(F.get(F.col(f"{at}.gaps"), F.lit(0)), F.array_join(rest, ""))).otherwise(text)
    none = F.array().cast("array<struct<kind:string,pseudonym:string>>")
    valid = F.transform(F.filter(hits, lambda x: x["pseudonym"].isNotNull()), lambda x: F.struct(x["kind"].alias("kind"), _value(x["pseudonym"]).alias("pseudonym")))
    out = [replaced.alias(c) if c == column else F.col(f"`{c}`") for c in docs.columns]
    return whole.select(*out, *([F.coalesce(valid, none).alias(found)] if found else []))
