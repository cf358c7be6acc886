"""Format-preserving pseudonyms for personal data, in DataFrame functions only.

What looks like personal data is found by one pattern and validated; what is
valid is permuted by a keyed Feistel network within its own format, so it stays
valid, equal values stay equal in all documents, and with the key the
permutation can be undone. What is not valid stays as it is.

* Numbers with rules of their own are taken apart into two mixed-radix halves
  (IPv4 addresses, social security numbers, dates 1900-2099) or permuted with
  their check digits made anew (payment cards: Luhn; IBAN: modulo 97).
* Other values (phone numbers, e-mail and IPv6 addresses, access keys,
  passwords) keep their punctuation, and each digit, small or capital letter
  becomes one of its kind (IPv6: each hexadecimal digit another one).

A half is changed by what a hash of the other half says; both kinds of halves
go through the same alternation. Every document is one row's work: no shuffle.

Repetitions without a bound are possessive: the matcher then loops where it
would otherwise recurse, so no text is too long for its stack.

E-mail addresses that differ in case only are one address: their pseudonyms
differ in case only, too. Not found: mail addresses with letters outside Latin-1 (left
whole), phone numbers without any punctuation, dates without leading zeros or with
names of months, private-key blocks, and values that are cut by a line's end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import free_names

#: The session setting with the key.
KEY_SETTING = "tripmill.pii.key"
#: A published key, for tests and examples only: who knows it can undo the pseudonyms.
EXAMPLE_KEY = "tripmill-example-key"
ROUNDS = 8

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
_EMAIL = rf"(?<![\p{{L}}\p{{N}}\p{{M}}._%+-])[{_LETTER}0-9._%+-]++@[{_LETTER}0-9-]++(?:\.[{_LETTER}0-9-]++)++(?![\p{{L}}\p{{N}}\p{{M}}])"
#: What a secret is called, after further words of its name.
_NAMES = r"(?:[A-Za-z0-9]{1,20}[_-]){0,4}?(?i:password|passwd|pwd|secret|token|api_key|apikey|access_key)"
_BEARER = r"(?i:bearer)\s(?=[A-Za-z._~+/-]{0,40}+\d)[A-Za-z0-9+/_-](?:[.=~]{0,3}+[A-Za-z0-9+/_-]){15,}+={0,2}+"
_TOKEN = r"gh[pousr]_[A-Za-z0-9]{36,255}+|xox[abprs]-[A-Za-z0-9-]{10,}+|AIza[A-Za-z0-9_-]{35}|sk-[A-Za-z0-9_-]{20,}+|eyJ[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}+"
_SECRET = rf"(?<![A-Za-z0-9])AKIA[0-9A-Z]{{16}}(?![A-Za-z0-9])|(?<![A-Za-z0-9_-])(?:{_TOKEN})(?![A-Za-z0-9])|(?<![A-Za-z0-9_-]){_BEARER}|(?<![A-Za-z0-9_-]){_NAMES}\s?[=:]\s?[\"']?[A-Za-z0-9+/_-](?:[.=]{{0,3}}+[A-Za-z0-9+/_-]){{7,}}+={{0,2}}+"
_PREFIX = rf"^(?:AKIA|gh[pousr]_|xox[abprs]-|AIza|sk-|eyJ|(?i:bearer)\s|{_NAMES}\s?[=:]\s?[\"']?)"
_GROUP = r"[0-9A-Fa-f]{1,4}"
_IPV6 = rf"(?<![0-9A-Za-z:.])(?:(?:{_GROUP}:){{7}}{_GROUP}|{_GROUP}(?::{_GROUP}){{1,5}}::(?:{_GROUP}(?::{_GROUP}){{0,4}})?|{_GROUP}::{_GROUP}(?::{_GROUP}){{1,5}})(?![0-9A-Za-z:])"
_IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
_DATE = r"(?<![\d./-])(?:(?:19|20)\d\d-[01]\d-[0-3]\d|[0-3]\d\.[01]\d\.(?:19|20)\d\d|[01]\d/[0-3]\d/(?:19|20)\d\d)(?![\d/-]|\.\d)"
_SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
_IP = rf"(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\.?\d)"
_CARD = r"(?<!\d)(?:\d{13,19}|\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{4}|\d{4}[ -]\d{6}[ -]\d{5})(?!\d)"
_PHONE = r"(?<![\d+])\+\d{1,3}[ .-]?\(?\d{2,4}\)?(?:[ .-]?\d{2,4}){2,3}(?!\d)|(?<![\d+(])\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)|(?<![\d.+-])\d{3}[.-]\d{3}[.-]\d{4}(?![\d-]|\.\d)"
#: Kinds in the order in which they are tried at a place.
KINDS = {"email": _EMAIL, "secret": _SECRET, "iban": _IBAN, "date": _DATE, "ssn": _SSN, "ip": _IP, "ipv6": _IPV6, "phone": _PHONE, "card": _CARD}
PATTERN = "|".join(f"(?:{p})" for p in KINDS.values())


def _bound(value: Column, use) -> Column:
    """use(value) with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _number(key: str, tag: str, round_: Column, half: Column) -> Column:
    """A 52-bit number that the key, the round and the other half determine."""
    return F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit(tag), round_.cast("string"), half.cast("string")), 256), 1, 13), 16, 10).cast("long")


def _halves(key: str, tag: str, left: Column, right: Column, a: int, b: int) -> Column:
    """struct(l, r): a permutation of pairs of a number below a and one below b."""
    pair = lambda l, r: F.struct(l.cast("long").alias("l"), r.cast("long").alias("r"))  # noqa: E731, E741

    def step(at: Column, i: Column) -> Column:
        return F.when(
            i % 2 == 1,
            pair((at["l"] + F.pmod(_number(key, tag, i, at["r"]), F.lit(a))) % a, at["r"]),
        ).otherwise(pair(at["l"], (at["r"] + F.pmod(_number(key, tag, i, at["l"]), F.lit(b))) % b))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), pair(left, right), step)


def _shift(c: Column, by: Column) -> Column:
    """The character ``by`` places on among the digits, small or capital letters, or small letters of Latin-1; others stay."""
    code = F.ascii(c)
    # à to ö and ø to þ
    latin = F.pmod(F.when(code < 247, code - 224).otherwise(code - 225) + by, F.lit(30))
    accented = F.char(F.when(latin < 23, latin + 224).otherwise(latin + 225).cast("long"))
    turn = lambda first, n: F.char((F.lit(first) + F.pmod(code - first + by, F.lit(n))).cast("long"))
    return F.when(code.between(48, 57), turn(48, 10)).when(code.between(97, 122), turn(97, 26)).when(code.between(65, 90), turn(65, 26)).when(code.between(224, 246) | code.between(248, 254), accented).otherwise(c)


def _shift_hex(c: Column, by: Column) -> Column:
    """The hexadecimal digit (small letters) ``by`` places on; others stay."""
    code = F.ascii(c)
    value = F.when(code.between(48, 57), code - 48).when(code.between(97, 102), code - 87)
    return F.when(value.isNull(), c).otherwise(F.substring(F.lit("0123456789abcdef"), F.pmod(value + by, F.lit(16)) + 1, F.lit(1)))


def _string(key: str, tag: str, value: Column, shift=_shift) -> Column:
    """A permutation of the strings of one format (at least two characters)."""
    half = F.floor(F.length(value) / 2).cast("int")

    def changed(part: Column, other: Column, i: Column) -> Column:
        digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit(tag), i.cast("string"), other), 512)
        by = lambda d, j: F.conv(d.substr(F.pmod(j * 4, F.lit(128)) + 1, F.lit(4)), 16, 10).cast("int")
        return _bound(digest, lambda d: F.array_join(F.transform(F.split(part, ""), lambda c, j: shift(c, by(d, j))), ""))

    pair = lambda l, r: F.struct(l.alias("l"), r.alias("r"))  # noqa: E731, E741

    def step(at: Column, i: Column) -> Column:
        return F.when(i % 2 == 1, pair(changed(at["l"], at["r"], i), at["r"])).otherwise(pair(at["l"], changed(at["r"], at["l"], i)))

    done = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), pair(F.substring(value, F.lit(1), half), F.substring(value, half + 1, F.length(value))), step)
    return _bound(done, lambda d: F.concat(d["l"], d["r"]))


def _luhn(digits: Column) -> Column:
    """The Luhn sum of a string of digits, modulo 10."""

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        return (total + F.when(i % 2 == 0, F.when(d > 4, d * 2 - 9).otherwise(d * 2)).otherwise(d)) % 10

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add)


def _fill(shape: Column, digits: Column) -> Column:
    """shape with its digits and letters replaced, in order, by those of ``digits``."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))

    def step(s: Column, i: Column) -> Column:
        c = shape.substr(i, F.lit(1))
        own = c.rlike("[0-9A-Za-z]")
        return F.struct(F.concat(s["out"], F.when(own, digits.substr(s["at"], F.lit(1))).otherwise(c)).alias("out"), F.when(own, s["at"] + 1).otherwise(s["at"]).alias("at"))

    return F.aggregate(F.sequence(F.lit(1), F.length(shape)), start, step)["out"]


def _card(key: str, value: Column) -> Column:
    """The first digit stays, the last makes the Luhn sum 0 again."""

    def made(d: Column) -> Column:
        middle = _string(key, "card", F.substring(d, F.lit(2), F.length(d) - 2))
        return _bound(F.concat(F.substring(d, 1, 1), middle), lambda m: _fill(value, F.concat(m, F.pmod(10 - _luhn(F.concat(m, F.lit("0"))), F.lit(10)).cast("string"))))

    return _bound(F.regexp_replace(value, "[ -]", ""), lambda d: F.when(_luhn(d) == 0, made(d)).otherwise(value))


def _mod97(value: Column) -> Column:
    def add(rest: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code >= 65, (rest * 100 + code - 55) % 97).otherwise((rest * 10 + code - 48) % 97)

    return F.aggregate(F.split(value, ""), F.lit(0), lambda rest, c: F.when(c == "", rest).otherwise(add(rest, c)))


def _iban(key: str, value: Column) -> Column:
    """The country stays, the check digits are made anew."""

    def made(v: Column) -> Column:
        land = F.substring(v, 1, 2)
        return _bound(_string(key, "iban", F.substring(v, F.lit(5), F.length(v))), lambda b: _fill(value, F.concat(land, F.lpad((98 - _mod97(F.concat(b, land, F.lit("00")))).cast("string"), 2, "0"), b)))

    valid = lambda v: F.length(v).between(15, 34) & (_mod97(F.concat(F.substring(v, F.lit(5), F.length(v)), F.substring(v, 1, 4))) == 1)
    return _bound(F.regexp_replace(value, " ", ""), lambda v: F.when(valid(v), made(v)).otherwise(value))


def _ip(key: str, value: Column) -> Column:
    part = lambda v, i: F.element_at(v, i).cast("long")
    out = lambda x: F.concat_ws(".", F.floor(x["l"] / 256).cast("string"), (x["l"] % 256).cast("string"), F.floor(x["r"] / 256).cast("string"), (x["r"] % 256).cast("string"))
    return _bound(F.split(value, r"\."), lambda v: _bound(_halves(key, "ip", part(v, 1) * 256 + part(v, 2), part(v, 3) * 256 + part(v, 4), 65536, 65536), out))


def _ssn(key: str, value: Column) -> Column:
    """Areas 001-899 without 666, groups 01-99, serials 0001-9999."""
    area, group, serial = (F.substring(value, a, n).cast("long") for a, n in ((1, 3), (5, 2), (8, 4)))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    index = F.when(area > 666, area - 2).otherwise(area - 1)

    def out(x: Column) -> Column:
        a = F.floor(x["l"] / 99)
        return F.concat_ws("-", *(F.lpad(v.cast("string"), n, "0") for v, n in ((F.when(a >= 665, a + 2).otherwise(a + 1), 3), (x["l"] % 99 + 1, 2), (x["r"] + 1, 4))))

    return F.when(valid, _bound(_halves(key, "ssn", index * 99 + group - 1, serial - 1, 898 * 99, 9999), out)).otherwise(value)


def _date(key: str, value: Column) -> Column:
    """Days 1900-01-01 to 2099-12-31: 73,049 = 17 x 4,297 of them."""
    shapes = ((r"^\d{4}-", "yyyy-MM-dd"), (r"^\d\d\.", "dd.MM.yyyy"), (r"^\d\d/", "MM/dd/yyyy"))

    def made(form: str) -> Column:
        out = lambda x: F.date_format(F.date_add(F.lit("1900-01-01").cast("date"), (x["l"] * 4297 + x["r"]).cast("int")), form)
        return _bound(
            F.datediff(F.try_to_timestamp(value, F.lit(form)).cast("date"), F.lit("1900-01-01").cast("date")),
            lambda day: F.when(day.isNull(), value).otherwise(_bound(_halves(key, "date", F.floor(day / 4297), day % 4297, 17, 4297), out)),
        )

    chosen = F.when(value.rlike(shapes[0][0]), made(shapes[0][1])).when(value.rlike(shapes[1][0]), made(shapes[1][1]))
    return chosen.when(value.rlike(shapes[2][0]), made(shapes[2][1])).otherwise(value)


def _phone(key: str, value: Column) -> Column:
    """A country code stays; the other digits are permuted."""

    def made(land: Column) -> Column:
        rest = F.substring(value, F.length(land) + 1, F.length(value))
        return _bound(F.regexp_replace(rest, r"\D", ""), lambda d: F.when(F.length(d) < 7, value).otherwise(F.concat(land, _fill(rest, _string(key, "phone", d)))))

    return _bound(F.regexp_extract(value, r"^\+\d{1,3}(?=[ .(-])", 0), made)


def _cased(made: Column, like: Column) -> Column:
    """made with capitals where ``like`` has them."""
    one = lambda c, l: F.when(l.rlike("\\p{Lu}"), F.upper(c)).otherwise(c)  # noqa: E731, E741
    return F.when(F.lower(like) == like, made).otherwise(F.array_join(F.zip_with(F.split(made, ""), F.split(like, ""), one), ""))


def _email(key: str, value: Column) -> Column:
    """The top-level domain and the capitals' places stay."""

    def made(t: Column) -> Column:
        own = F.substring(value, F.lit(1), F.length(value) - F.length(t))
        return F.concat(_cased(_string(key, "email", F.lower(own)), own), t)

    return _bound(F.regexp_extract(value, rf"\.[{_LETTER}0-9-]+$", 0), made)


def _ipv6(key: str, value: Column) -> Column:
    """Valid with eight groups, or fewer and one gap."""
    return _cased(_string(key, "ipv6", F.lower(value), _shift_hex), value)


def _secret(key: str, value: Column) -> Column:
    """The name and the prefix stay."""
    return _bound(F.regexp_extract(value, _PREFIX, 0), lambda n: F.concat(n, _string(key, "secret", F.substring(value, F.length(n) + 1, F.length(value)))))


def pseudonym(value: Column, key: str) -> Column:
    """The pseudonym of one match of PATTERN; the match itself where it is not valid."""
    whole = lambda p: value.rlike(f"^(?:{p})$")
    made = {"email": _email, "secret": _secret, "iban": _iban, "date": _date, "ssn": _ssn, "ip": _ip, "ipv6": _ipv6, "phone": _phone, "card": _card}
    out = F.when(F.lit(False), value)
    for kind, pattern in KINDS.items():
        out = out.when(whole(pattern), made[kind](key, value))
    return out.otherwise(value)


def pseudonymize(docs: DataFrame, key: str | None = None, text: str = "text", count: str | None = None) -> DataFrame:
    """docs with the text's personal data replaced, all other columns as they are.

    The key is the argument or the session's ``tripmill.pii.key``; there is no
    other, as pseudonyms under a key that all know are none. With ``count``, a
    column of that name (not one of docs) has the number of values replaced.
    Null texts stay null; empty texts and those without matches are not touched,
    whatever their length. A row's result depends on its text alone, so repeated
    rows stay equal, and any name is free for further columns.
    """
    key = key or docs.sparkSession.conf.get(KEY_SETTING, None)
    if not key:
        raise ValueError(f"no key for pseudonyms: pass one or set {KEY_SETTING}")
    if count in docs.columns:
        raise ValueError(f"there is a column {count} already")
    was, now = free_names(docs.columns, "found", "made")
    t = F.col(f"`{text}`")
    likely = t.rlike("[0-9@:]|AKIA|eyJ|xox|sk-|gh[pousr]_") | t.rlike(_NAMES)
    found = F.when(likely, F.regexp_extract_all(t, F.lit(PATTERN), F.lit(0))).otherwise(F.array().cast("array<string>"))
    made = docs.withColumn(was, found)
    made = made.withColumn(now, F.transform(was, lambda v: pseudonym(v, key)))
    between = F.split(t, PATTERN, -1)
    joined = F.array_join(F.zip_with(between, now, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    out = {text: F.when(F.size(was) > 0, joined).otherwise(t)}
    if count:
        out[count] = F.size(F.filter(F.zip_with(was, now, lambda a, b: a != b), lambda x: x)).cast("long")
    return made.withColumns(out).drop(was, now)
