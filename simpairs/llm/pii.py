"""Operator 2, PII: format-preserving Feistel pseudonyms, in DataFrame functions only.

Candidates are found by one pattern and validated: card numbers by the Luhn sum, IBANs by modulo 97, dates by the calendar,
addresses by their octets. A valid value is permuted within its format by a ten-round Feistel network under a secret
key; the network is a bijection of [0, a * b), one half taken modulo a, the other modulo b, and
values outside the domain are walked on until they are inside. So the same value gets the same pseudonym in every document, different
values get different ones, separators stay, and the result is valid again (check digits are computed anew).

    card     all digits but the last, which becomes the Luhn digit
    iban     what follows the two letters and check digits, digits among digits and capitals among capitals; check digits
             modulo 97. Of the length of its country, or of any from 11 to 31 where that is not known
    phone    the digits after the country code, or all of a national number (blanks, points or dashes between its groups)
    ssn      all nine digits
    ip       the address as a 32-bit number
    date     the day within 1900 to 2099 (others stay); a time after it, from a T on, stays
    secret   hex strings of 32 to 64 digits, in runs of up to 16 digits
    email    the local part becomes u and 15 hex digits of a keyed hash (of the whole address, letters lower-cased)

Numbers that fail their check stay as they are. Rows are rewritten where they stand: no shuffle, and only texts that hold a
digit or an @ are searched.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from simpairs.llm.common import boxed, free_name
from simpairs.llm.fingerprints import let

ROUNDS = 10
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
#: characters after the check digits, and the countries with as many
_IBAN_LENGTHS = {
    11: "NO", 12: "BE", 14: "DK|FI|FK|FO|GL|NL|SD", 15: "MK|SI", 16: "AT|BA|EE|KZ|LT|LU|MN|XK", 17: "CH|HR|LI|LV",
    18: "BG|BH|CR|DE|GB|GE|IE|ME|RS|VA", 19: "AE|GI|IL|IQ|OM|SO|TL", 20: "AD|CZ|ES|MD|PK|RO|SA|SE|SK|TN|VG", 21: "LY|PT|ST",
    22: "IS|TR", 23: "BI|DJ|FR|GR|IT|MC|MR|SM", 24: "AL|AZ|BY|CY|DO|GT|HU|LB|NI|PL|SV", 25: "BR|EG|PS|QA|UA", 26: "JO|KW|MU|YE",
    27: "MT|SC", 28: "LC", 29: "RU"}
#: country codes of one and two digits; all others have three
_COUNTRY = r"^\+(?:1|7|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"
_IBAN = "|".join([*(rf"(?:{c})\d{{2}}(?: ?[A-Z0-9]){{{n}}}" for n, c in _IBAN_LENGTHS.items()),
                  r"[A-Z]{2}\d{2}(?: ?\d{4}){3,6}(?: ?\d{1,3})?",
                  r"[A-Z]{2}\d{2}(?:(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?|(?: ?[A-Z0-9]{4}){2} ?[A-Z0-9]{3})"])
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+\-@])[\p{L}\p{N}._%+\-]{1,64}@(?:[A-Za-z0-9\-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![\p{L}\p{N}\-@])",
    "secret": r"(?<![\p{L}\p{N}])(?=[0-9A-Fa-f]*\d)(?=[0-9A-Fa-f]*[A-Fa-f])(?:[0-9a-f]{32,64}|[0-9A-F]{32,64})(?![\p{L}\p{N}])",
    "iban": rf"(?<![\p{{L}}\p{{N}}])(?:{_IBAN})(?![\p{{L}}\p{{N}}])",
    "ip": rf"(?<![\p{{L}}\p{{N}}.])(?:{_OCTET}\.){{3}}{_OCTET}(?![\p{{L}}\p{{N}}]|\.\d)",
    "date": r"(?<![\p{L}\p{N}\-/.])(?:\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{2}/\d{2}/\d{4}|\d{1,2}\.\d{1,2}\.\d{4})"
            r"(?:(?=T\d{2}:?\d{2})|(?![\p{L}\p{N}]|[\-/.]\d))",
    "phone": r"(?<![\p{L}\p{N}+])(?:\+\d{1,3}[ .\-]?\(\d{2,4}\)[ .\-]?\d{3,4}[ .\-]\d{3,4}|\+\d{1,3}(?:[ .\-]\d{2,4}){2,4}"
             r"|\+\d{1,3}[ .\-]\d{2,5}[ .\-]\d{5,8}|\+\d{8,14}"
             r"|\(\d{3}\) ?\d{3}[ .\-]\d{4}|\d{3}[ .\-]\d{3}[ .\-]\d{4})(?![\p{L}\p{N}]|-\d)",
    "ssn": r"(?<![\p{L}\p{N}\-])\d{3}-\d{2}-\d{4}(?![\p{L}\p{N}]|-\d)",
    "card": r"(?<![\p{L}\p{N}\-])(?:\d{13,19}|\d{4} \d{4} \d{4} \d{4}|\d{4}-\d{4}-\d{4}-\d{4}|\d{4}[ \-]\d{6}[ \-]\d{5})(?![\p{L}\p{N}]|-\d)",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())


def _keyed(key: str, *parts: Column) -> Column:
    """A number below 2^60 from the key and the parts."""
    joined = F.concat_ws("|", F.lit(key), *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.sha2(joined, 256), 1, 15), 16, 10).cast("long")


def feistel(x: Column, a: Column, b: Column, key: str, tweak: Column) -> Column:
    """A keyed bijection of [0, a * b); a * b below 2^62."""
    def step(s: Column, i: Column) -> Column:
        left = F.pmod(s["l"] + F.pmod(_keyed(key, tweak, i, s["r"]), a), a)
        right = F.pmod(s["r"] + F.pmod(_keyed(key, tweak, i, s["l"]), b), b)
        return F.when(i % 2 == 0, F.struct(left.alias("l"), s["r"].alias("r"))).otherwise(F.struct(s["l"].alias("l"), right.alias("r")))
    start = F.struct(F.floor(F.call_function("div", x, b)).cast("long").alias("l"), F.pmod(x, b).alias("r"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step, lambda s: s["l"] * b + s["r"])


def walked(x: Column, size: int, a: int, b: int, key: str, tweak: Column) -> Column:
    """A keyed bijection of [0, size) for size <= a * b: walk on while outside. With a * b within 1 % of
    size, eight steps leave fewer than one in 10^16 outside; null then (the caller keeps the value)."""
    go = lambda v: feistel(v, F.lit(a).cast("long"), F.lit(b).cast("long"), key, tweak)
    out = F.aggregate(F.sequence(F.lit(1), F.lit(8)), go(x), lambda v, _: F.when(v < size, v).otherwise(go(v)))
    return F.when(out < size, out)


def _power(n: Column, base: int = 10) -> Column:
    return F.pow(F.lit(float(base)), n).cast("long")


def _digits_permuted(d: Column, key: str, kind: str) -> Column:
    """A string of 2 to 18 digits (leading zeros count), permuted among those of its length."""
    n = F.length(d)
    half = F.floor(n / 2).cast("int")
    number = feistel(d.cast("long"), _power(n - half), _power(half), key, F.concat(F.lit(kind), n.cast("string")))
    return F.lpad(number.cast("string"), n, F.lit("0"))


def _hex_permuted(h: Column, key: str) -> Column:
    """Hex digits in runs of up to 14, each permuted; the place of a run is part of the tweak."""
    runs = F.transform(F.sequence(F.lit(0), F.floor((F.length(h) - 1) / 14).cast("int")), lambda k: F.substring(h, k * 14 + 1, F.lit(14)))

    def one(r: Column, k: Column) -> Column:
        n = F.length(r)
        half = F.floor(n / 2).cast("int")
        number = feistel(F.conv(r, 16, 10).cast("long"), _power(n - half, 16), _power(half, 16), key, F.concat_ws(".", F.lit("hex"), n.cast("string"), k.cast("string")))
        return F.lpad(F.lower(F.hex(number)), n, F.lit("0"))
    return F.array_join(F.transform(runs, one), "")


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, r"[^0-9]", "")


def _letters_permuted(a: Column, key: str) -> Column:
    """Capitals in runs of up to 10, each permuted; the place of a run is part of the tweak. Empty stays empty."""
    runs = F.transform(F.sequence(F.lit(0), F.floor((F.length(a) - 1) / 10).cast("int")), lambda k: F.substring(a, k * 10 + 1, F.lit(10)))

    def one(r: Column, k: Column) -> Column:
        n = F.length(r)
        half = F.floor(n / 2).cast("int")
        value = F.aggregate(F.sequence(F.lit(1), n), F.lit(0).cast("long"), lambda v, i: v * 26 + F.ascii(F.substring(r, i, F.lit(1))) - 65)
        number = feistel(value, _power(n - half, 26), _power(half, 26), key, F.concat_ws(".", F.lit("letters"), n.cast("string"), k.cast("string")))
        return let(number, lambda x: F.array_join(F.transform(F.sequence(F.lit(1), n), lambda i: F.char(
            F.pmod(F.call_function("div", x, _power(n - i, 26)), F.lit(26)) + 65)), ""))
    return F.when(F.length(a) > 0, F.array_join(F.transform(runs, one), "")).otherwise(F.lit(""))


def _refilled(m: Column, chars: Column, which: str = "0-9") -> Column:
    """The characters of `m` among `which` (digits) replaced in turn by `chars`; all else stays."""
    return let(chars, lambda d: F.array_join(F.transform(
        F.sequence(F.lit(1), F.length(m)),
        lambda i: F.when(F.substring(m, i, F.lit(1)).rlike(f"[{which}]"),
                         F.substring(d, F.length(F.regexp_replace(F.substring(m, F.lit(1), i), f"[^{which}]", "")), F.lit(1)))
        .otherwise(F.substring(m, i, F.lit(1)))), ""))


def luhn_digit(payload: Column) -> Column:
    """The check digit that belongs after `payload`."""
    def add(total: Column, i: Column) -> Column:
        d = F.substring(payload, -i, F.lit(1)).cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return total + d - F.when(d > 9, 9).otherwise(0)
    total = F.aggregate(F.sequence(F.lit(1), F.length(payload)), F.lit(0), add)
    return F.pmod(F.lit(10) - total % 10, F.lit(10)).cast("string")


def _body(d: Column) -> Column:
    return F.substring(d, F.lit(1), F.length(d) - 1)


def _card(m: Column, key: str) -> Column:
    def change(d: Column) -> Column:
        new = let(_digits_permuted(_body(d), key, "card"), lambda p: F.concat(p, luhn_digit(p)))
        return F.when(luhn_digit(_body(d)) == F.substring(d, -1, 1), _refilled(m, new))
    return let(_digits(m), change)


def _as_number(s: Column) -> Column:
    """Digits as they are, capitals as 10 to 35."""
    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(s)), lambda i: let(F.substring(s, i, F.lit(1)), lambda c: F.when(
        c.rlike("[A-Z]"), (F.ascii(c) - 55).cast("string")).otherwise(c))), "")


def _mod97(number: Column) -> Column:
    return F.aggregate(F.sequence(F.lit(1), F.length(number)), F.lit(0), lambda s, i: (s * 10 + F.substring(number, i, F.lit(1)).cast("int")) % 97)


def _iban(m: Column, key: str) -> Column:
    letters = F.substring(m, 1, 2)

    def permuted(d: Column) -> Column:
        # up to 18 digits in one network, more in two parts; none stay none
        cut_at = F.least(F.lit(12), F.length(d) - 2)
        safe = F.when(d == "", F.lit("0")).otherwise(d)
        return F.when(d == "", d).when(F.length(d) <= 18, _digits_permuted(safe, key, "iban")).otherwise(F.concat(
            _digits_permuted(F.substring(d, F.lit(1), cut_at), key, "iban-a"),
            _digits_permuted(F.substring(d, cut_at + 1, F.length(d) - cut_at), key, "iban-b")))

    def change(c: Column) -> Column:  # without blanks: letters, check digits, body
        check, body = F.substring(c, 3, 2), F.substring(c, F.lit(5), F.length(c) - 4)
        new = let(body, lambda b: _refilled(_refilled(b, let(_digits(b), permuted)),
                                            let(F.regexp_replace(b, "[^A-Z]", ""), lambda a: _letters_permuted(a, key)), "A-Z"))
        fresh = let(new, lambda b: F.concat(letters, F.lpad((F.lit(98) - _mod97(_as_number(F.concat(b, letters, F.lit("00"))))).cast("string"),
                                                            F.lit(2), F.lit("0")), b))
        return F.when(_mod97(_as_number(F.concat(body, letters, check))) == 1, _refilled(m, fresh, "A-Z0-9"))
    return let(F.replace(m, F.lit(" "), F.lit("")), change)


def _phone(m: Column, key: str) -> Column:
    country = F.regexp_extract(m, r"^(\+\d{1,3})(?=[ .\-(])", 1)
    country = F.when(country != "", country).otherwise(F.regexp_extract(m, _COUNTRY, 0))

    def change(c: Column) -> Column:
        rest = F.substring(m, F.length(c) + 1, F.length(m) - F.length(c))
        return F.concat(c, _refilled(rest, _digits_permuted(_digits(rest), key, "phone")))
    return let(country, change)


def _ip(m: Column, key: str) -> Column:
    octet = lambda k: F.get(F.split(m, r"\."), F.lit(k)).cast("long")
    half = F.lit(1 << 16).cast("long")
    number = feistel(octet(0) * (1 << 24) + octet(1) * (1 << 16) + octet(2) * 256 + octet(3), half, half, key, F.lit("ip"))
    return let(number, lambda x: F.concat_ws(".", *[F.pmod(F.shiftright(x, s), F.lit(256)).cast("string") for s in (24, 16, 8, 0)]))


def _with(f, *more):
    return lambda x: f(x, *more)


DAYS = 73049  # 1900-01-01 to 2099-12-31


def _date(m: Column, key: str) -> Column:
    out = F.lit(None).cast("string")
    for pattern, form in ((r"^\d{4}-", "yyyy-MM-dd"), (r"^\d{4}/", "yyyy/MM/dd"), (r"^\d{2}/", "dd/MM/yyyy"),
                          (r"^\d{1,2}\.", "d.M.yyyy"), (r"^\d{2}\.\d{2}\.", "dd.MM.yyyy")):
        def change(day: Column, form: str) -> Column:
            at = F.datediff(day, F.lit("1900-01-01").cast("date")).cast("long")
            new = walked(at, DAYS, 271, 270, key, F.lit("date"))
            return F.when((at >= 0) & (at < DAYS), F.date_format(F.date_add(F.lit("1900-01-01").cast("date"), new.cast("int")), form))
        day = F.try_to_timestamp(m, F.lit(form)).cast("date")
        if form == "dd/MM/yyyy":  # month first where only that is a date
            american = F.try_to_timestamp(m, F.lit("MM/dd/yyyy")).cast("date")
            value = F.coalesce(let(day, _with(change, form)), let(american, _with(change, "MM/dd/yyyy")))
        else:
            value = let(day, _with(change, form))
        out = F.when(m.rlike(pattern), value).otherwise(out)
    return out


def _email(m: Column, key: str) -> Column:
    return F.concat(F.lit("u"), F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit("email"), F.lower(m)), 256), 1, 15),
                    F.regexp_extract(m, r"@.*$", 0))


def _secret(m: Column, key: str) -> Column:
    new = _hex_permuted(F.lower(m), key)
    return F.when(m.rlike("[A-F]"), F.upper(new)).otherwise(new)


_MAKE = {"email": _email, "secret": _secret, "iban": _iban, "ip": _ip, "date": _date, "phone": _phone,
         "ssn": lambda m, key: _refilled(m, _digits_permuted(_digits(m), key, "ssn")), "card": _card}


def pseudonym(m: Column, key: str) -> Column:
    """struct(kind, value) of a match of ANY; value is null where the match is not valid."""
    out = F.struct(F.lit("none").alias("kind"), F.lit(None).cast("string").alias("value"))
    for kind in reversed(list(PATTERNS)):
        out = F.when(m.rlike(f"^(?:{PATTERNS[kind]})$"), F.struct(F.lit(kind).alias("kind"), _MAKE[kind](m, key).alias("value"))).otherwise(out)
    return out


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text", found_col: str = "__found") -> DataFrame:
    """`docs` with pseudonyms in `text_col`, plus `found_col`: the kinds replaced, in order of the text.

    Null texts stay null and empty ones empty, with nothing found; every row comes back, repeated rows alike; other columns
    are not touched, whatever their names (beside one named `found_col` the new one gets underscores before its name). Dates
    are read day first where that is possible. An empty table gives no rows."""
    text = F.col("text")
    matches = F.when(text.rlike("[0-9@]"), F.regexp_extract_all(text, F.lit(f"({ANY})"), F.lit(0)))
    made = boxed(docs, text=F.col(f"`{text_col}`")).withColumn("matches", matches).withColumn("new", F.when(F.size("matches") > 0, F.transform(
        "matches", lambda m: F.struct(m.alias("old"), pseudonym(m, key).alias("new")))))
    parts = F.zip_with(F.split(text, ANY, -1), "new", lambda gap, p: F.concat(
        gap, F.coalesce(p["new"]["value"], p["old"], F.lit(""))))
    kinds = F.transform(F.filter("new", lambda p: p["new"]["value"].isNotNull()), lambda p: p["new"]["kind"])
    changed = F.when(F.col("new").isNotNull(), F.array_join(parts, "")).otherwise(text)
    return (made.withColumn("changed", changed).withColumn("found", F.coalesce(kinds, F.array().cast("array<string>")))
            .select(*[F.col("changed").alias(c) if c == text_col else F.col("all").getField(c).alias(c) for c in docs.columns],
                    F.col("found").alias(free_name(docs, found_col))))
