"""Format-preserving pseudonyms for personal data (operator 2, native).

Candidates are found with one regular expression, validated (Luhn, mod 97,
calendar, octet and area ranges) and replaced by a keyed permutation of their
own domain: a generalised Feistel network over Z_a x Z_b, which is a bijection
for any a and b, so a valid value becomes a valid value of the same format and
equal values stay equal in every document. The digit layout (spaces, dashes,
brackets) is kept. A run of digit groups is searched for cards from group border to
group border, the longest first; what is left of it, and of an IBAN candidate that
fails, is searched again for the other kinds. Inside a run a card starts with a group
of four digits or more. A date in another notation, or a card with other separators,
gets the same pseudonym in its own notation.

Only SQL functions, one pass, no shuffle: linkage needs no table of values.

Domains: cards - payload digits, check digit recomputed; IBAN - digits of the
account part, check digits recomputed; US social security numbers - the valid
area, group and serial numbers; phones - ten digits, where area and exchange from
200 stay so; phones with another country code keep it, and all their other digits are
permuted; IPv4 - 32 bits; dates - the 73,000 days from 1900-01-01 as yyyy-mm-dd,
mm/dd/yyyy or dd.mm.yyyy; mail - letters and digits of the local part, the
domain is kept. Anything that fails its validation is left as it is.

Defined results: a null text stays null with zero counts, an empty one stays
empty; a null ``doc_id`` stays null; repeated rows are each rewritten alike; an
empty table gives an empty table. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
KINDS = ("mail", "iban", "ip", "date", "ssn", "phone", "card")
# IBAN length of each registered country.
_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK|FI|FO|GL|NL", 19: "MK|SI", 20: "AT|BA|EE|KZ|LT|LU|XK", 21: "CH|CR|HR|LI|LV",
    22: "BG|BH|DE|GB|GE|IE|ME|RS|VA", 23: "AE|GI|IL|IQ|OM|SO|TL", 24: "AD|CZ|ES|MD|PK|RO|SA|SE|SK|TN|VG", 25: "LY|PT|ST",
    26: "IS|TR", 27: "BI|DJ|FR|GR|IT|MC|MR|SM", 28: "AL|AZ|BY|CY|DO|GT|HU|LB|NI|PL|SV", 29: "BR|EG|PS|QA|UA",
    30: "JO|KW|MU", 31: "MT|SC", 32: "LC", 33: "RU",
}
_KNOWN = "|".join(_LENGTHS.values())
_IBAN = "|".join(rf"(?:{c})\d{{2}}(?: ?[A-Z0-9]){{{n - 4}}}" for n, c in _LENGTHS.items())
# A group of four digits or more that begins a run as long as a card.
_CARD_NEXT = r"[ -]\d{4}(?:[ -]?\d){9}"
_SIMPLE = (
    r"(?<![A-Za-z0-9.])(?:\d{1,3}\.){3}\d{1,3}(?![A-Za-z0-9]|\.\d)",
    r"(?<![A-Za-z0-9/.-])(?:\d{4}-\d{2}-\d{2}(?=T\d)|(?:\d{4}-\d{2}-\d{2}|\d{2}/\d{2}/\d{4}|\d{2}\.\d{2}\.\d{4})(?![A-Za-z0-9/-]))",
    r"(?<![A-Za-z0-9-])\d{3}-\d{2}-\d{4}(?![A-Za-z0-9-])",
    r"(?<![A-Za-z0-9])(?:\+?1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![A-Za-z0-9])",
    r"(?<![A-Za-z0-9])(?:\+1[ .-]?\d{10}|1?[2-9]\d{9})(?![A-Za-z0-9])",
    rf"(?<![A-Za-z0-9+])\+[2-9](?:(?!{_CARD_NEXT})[ .()/-]{{0,3}}\d){{7,14}}(?![A-Za-z0-9])",
)
_RUN = r"(?<![A-Za-z0-9])\d(?:[ -]?\d){12,}+[A-Za-z0-9]*+"
SIMPLE = "|".join(_SIMPLE)
CANDIDATE = "|".join((
    # a local part has at most 64 characters; possessive groups match in a loop, others recurse once per label
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    rf"(?<![A-Za-z0-9])(?:{_IBAN})(?![A-Za-z0-9])",
    rf"(?<![A-Za-z0-9])[A-Z]{{2}}\d{{2}}(?:(?! (?:{_KNOWN})\d\d) ?[A-Z0-9]{{4}}){{2,7}}(?:(?! (?:{_KNOWN})\d\d) ?[A-Z0-9]{{1,3}})?(?![A-Za-z0-9])",
    *_SIMPLE, _RUN,
))
_SHAPES = {
    "mail": "@", "iban": r"^[A-Z]{2}\d{2}", "ip": r"^(?:\d{1,3}\.){3}\d{1,3}$",
    "date": r"^(?:\d{4}-\d{2}-\d{2}|\d{2}[/.]\d{2}[/.]\d{4})$", "ssn": r"^\d{3}-\d{2}-\d{4}$",
    "phone": r"^(?:(?:\+?1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}|\+1[ .-]?\d{10}|1?\d{10}|\+[2-9].*)$",
}
_ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"
FIRST_DAY, DAYS = "1900-01-01", (250, 292)


def _long(x: Column | int) -> Column:
    return (x if isinstance(x, Column) else F.lit(x)).cast("long")


def _prf(key: str, kind: str, i: Column, x: Column) -> Column:
    """60 pseudo-random bits of (key, kind, round, value)."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), i.cast("string"), x.cast("string")).cast("binary"), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def feistel(key: str, kind: str, value: Column, a: Column | int, b: Column | int) -> Column:
    """Keyed permutation of ``value`` in [0, a * b)."""
    a, b = _long(a), _long(b)

    def turn(acc: Column, i: Column) -> Column:
        left, right = acc["l"], acc["r"]
        return F.struct(
            F.when(i % 2 == 1, (left + F.pmod(_prf(key, kind, i, right), a)) % a).otherwise(left).alias("l"),
            F.when(i % 2 == 0, (right + F.pmod(_prf(key, kind, i, left), b)) % b).otherwise(right).alias("r"),
        )

    start = F.struct(_div(value, b).alias("l"), (value % b).alias("r"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn, lambda acc: acc["l"] * b + acc["r"])


def _div(x: Column, y: Column) -> Column:
    """Exact integer quotient."""
    return F.floor((x - x % y).cast("decimal(38,0)") / y.cast("decimal(38,0)")).cast("long")


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and pass it to ``use``."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _pad(x: Column, n: Column | int) -> Column:
    return F.lpad(x.cast("string"), n if isinstance(n, Column) else F.lit(n), F.lit("0"))


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, r"[^0-9]", "")


def _relayout(m: Column, digits: Column) -> Column:
    """``m`` with its digits replaced, in order, by ``digits``."""
    place = lambda i: F.length(_digits(m.substr(F.lit(1), i)))
    char = lambda i: m.substr(i, F.lit(1))
    return F.array_join(
        F.transform(
            F.sequence(F.lit(1), F.length(m)),
            lambda i: F.when(char(i).rlike("[0-9]"), digits.substr(place(i), F.lit(1))).otherwise(char(i)),
        ), "",
    )


def _permute_digits(key: str, kind: str, s: Column) -> Column:
    """Keyed permutation of the digit strings of the length of ``s`` (at most 36)."""
    n = F.length(s)
    cut = F.floor(n / 2).cast("int")
    low = (n - cut).cast("int")
    a, b = F.pow(F.lit(10.0), cut).cast("long"), F.pow(F.lit(10.0), low).cast("long")
    left = F.when(cut > 0, s.substr(F.lit(1), cut)).otherwise("0").cast("long")
    right = s.substr(cut + 1, low).cast("long")

    def turn(acc: Column, i: Column) -> Column:
        return F.struct(
            F.when(i % 2 == 1, (acc["l"] + F.pmod(_prf(key, kind, i, acc["r"]), a)) % a).otherwise(acc["l"]).alias("l"),
            F.when(i % 2 == 0, (acc["r"] + F.pmod(_prf(key, kind, i, acc["l"]), b)) % b).otherwise(acc["r"]).alias("r"),
        )

    return F.aggregate(
        F.sequence(F.lit(1), F.lit(ROUNDS)), F.struct(left.alias("l"), right.alias("r")), turn,
        lambda acc: F.concat(F.when(cut > 0, _pad(acc["l"], cut)).otherwise(F.lit("")), _pad(acc["r"], low)),
    )


def _luhn_sum(payload: Column) -> Column:
    """Luhn sum of the digits before the check digit."""
    back = F.reverse(payload)
    each = F.transform(F.sequence(F.lit(1), F.length(payload)), lambda i: F.when(
        i % 2 == 1, F.element_at(F.lit([0, 2, 4, 6, 8, 1, 3, 5, 7, 9]), back.substr(i, F.lit(1)).cast("int") + 1)
    ).otherwise(back.substr(i, F.lit(1)).cast("int")))
    return F.aggregate(each, F.lit(0), lambda acc, x: acc + x)


def _check_digit(payload: Column) -> Column:
    return ((10 - _luhn_sum(payload) % 10) % 10).cast("string")


def _card(key: str, m: Column) -> Column:
    def change(d: Column) -> Column:
        n = F.length(d)
        payload = d.substr(F.lit(1), n - 1)
        return F.when(
            d.substr(n, F.lit(1)) == _check_digit(payload),
            _let(_permute_digits(key, "card", payload), lambda p: _relayout(m, F.concat(p, _check_digit(p)))),
        )

    return _let(_digits(m), change)


def _mod97(s: Column) -> Column:
    """Remainder by 97 of an IBAN rearranged for its check (letters count 10 to 35)."""
    alphabet = F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    chars = F.transform(F.sequence(F.lit(1), F.length(s)), lambda i: s.substr(i, F.lit(1)))
    return F.aggregate(chars, F.lit(0), lambda acc, c: (
        acc * F.when(c.rlike("[A-Z]"), 100).otherwise(10) + F.call_function("locate", c, alphabet) - 1
    ) % 97)


def _iban(key: str, m: Column) -> Column:
    def change(s: Column) -> Column:
        country, account = s.substr(1, 2), s.substr(F.lit(5), F.length(s))
        valid = (F.length(s) >= 15) & (F.length(s) <= 34) & (_mod97(F.concat(account, s.substr(1, 4))) == 1)

        def spell(new: Column) -> Column:
            check = _pad(98 - _mod97(F.concat(new, country, F.lit("00"))), 2)
            # the same characters in the layout of m
            whole = F.concat(country, check, new)
            return F.array_join(F.transform(F.sequence(F.lit(1), F.length(m)), lambda i: F.when(
                m.substr(i, F.lit(1)) == " ", F.lit(" ")
            ).otherwise(whole.substr(F.length(F.regexp_replace(m.substr(F.lit(1), i), " ", "")), F.lit(1)))), "")

        numbers = _digits(account)
        return F.when(valid & (F.length(numbers) > 1), _let(_permute_digits(key, "iban", numbers), lambda d: _let(_relayout(account, d), spell)))

    return _let(F.regexp_replace(m, " ", ""), change)


def _ip(key: str, m: Column) -> Column:
    octets = F.transform(F.split(m, r"\."), lambda x: x.cast("long"))
    number = F.aggregate(octets, _long(0), lambda acc, x: acc * 256 + x)
    spell = lambda v: F.concat_ws(".", *[F.shiftright(v, s).bitwiseAND(F.lit(255)).cast("string") for s in (24, 16, 8, 0)])
    return F.when(F.forall(octets, lambda x: x <= 255), _let(feistel(key, "ip", number, 65536, 65536), spell))


def _date(key: str, m: Column) -> Column:
    iso, us = m.contains("-"), m.contains("/")
    day = (
        F.when(iso, F.try_to_date(m, "yyyy-MM-dd"))
        .when(us, F.try_to_date(m, "MM/dd/yyyy"))
        .otherwise(F.try_to_date(m, "dd.MM.yyyy"))
    )
    index = F.datediff(day, F.to_date(F.lit(FIRST_DAY))).cast("long")
    a, b = DAYS

    def spell(i: Column) -> Column:
        new = F.date_add(F.to_date(F.lit(FIRST_DAY)), i.cast("int"))
        return (
            F.when(iso, F.date_format(new, "yyyy-MM-dd"))
            .when(us, F.date_format(new, "MM/dd/yyyy"))
            .otherwise(F.date_format(new, "dd.MM.yyyy"))
        )

    return F.when((index >= 0) & (index < a * b), _let(feistel(key, "date", index, a, b), spell))


def _ssn(key: str, m: Column) -> Column:
    area, group, serial = (F.split(m, "-")[i].cast("long") for i in range(3))
    valid = (area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0)
    rank = F.when(area < 666, area - 1).otherwise(area - 2)  # 0 to 897
    index = (rank * 99 + group - 1) * 9999 + serial - 1

    def spell(v: Column) -> Column:
        r = _div(v, _long(99 * 9999))
        return F.concat_ws(
            "-", _pad(F.when(r < 665, r + 1).otherwise(r + 2), 3), _pad(_div(v, _long(9999)) % 99 + 1, 2), _pad(v % 9999 + 1, 4)
        )

    return F.when(valid, _let(feistel(key, "ssn", index, 898 * 99, 9999), spell))


# (least area, least exchange, number of exchanges, Feistel factors): assignable
# numbers stay assignable; the two classes of other numbers stay in their class.
_PHONES = ((200, 200, 800, 80_000, 80_000), (200, 0, 200, 40_000, 40_000), (0, 0, 1000, 40_000, 50_000))


_COUNTRY = r"^(?:7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"


def _phone(key: str, m: Column) -> Column:
    def abroad(d: Column) -> Column:
        code = F.regexp_extract(d, _COUNTRY, 0)
        rest = d.substr(F.length(code) + 1, F.length(d))
        return _relayout(m, F.concat(code, _permute_digits(key, "abroad", rest)))

    def change(d: Column) -> Column:
        ten = F.right(d, F.lit(10))
        area, exchange, line = ten.substr(1, 3).cast("long"), ten.substr(4, 3).cast("long"), ten.substr(7, 4).cast("long")

        def within(low: int, first: int, many: int, a: int, b: int) -> Column:
            index = ((area - low) * many + exchange - first) * 10000 + line
            return _let(feistel(key, f"phone{low}.{first}", index, a, b), lambda v: _relayout(m, F.concat(
                d.substr(F.lit(1), F.length(d) - 10), _pad(_div(v, _long(10000 * many)) + low, 3),
                _pad(_div(v, _long(10000)) % many + first, 3), _pad(v % 10000, 4),
            )))

        good, odd, low = (within(*x) for x in _PHONES)
        return F.when(m.rlike(r"^\+[2-9]"), abroad(d)).when((area >= 200) & (exchange >= 200), good).when(area >= 200, odd).otherwise(low)

    return _let(_digits(m), change)


def _mail(key: str, m: Column) -> Column:
    """Feistel over the two halves of the letters and digits of the local part."""
    alphabet, n = F.lit(_ALPHABET), len(_ALPHABET)

    def shifted(part: Column, other: Column, i: Column) -> Column:
        stream = F.sha2(F.concat_ws("|", F.lit(key), F.lit("mail"), i.cast("string"), F.length(part).cast("string"), other).cast("binary"), 256)
        return F.array_join(F.transform(F.sequence(F.lit(1), F.length(part)), lambda k: alphabet.substr((
            F.call_function("locate", part.substr(k, F.lit(1)), alphabet) - 1
            + F.conv(stream.substr((k - 1) % 16 * 4 + 1, F.lit(4)), 16, 10).cast("int")
        ) % n + 1, F.lit(1))), "")

    def permute(s: Column) -> Column:
        cut = F.ceil(F.length(s) / 2).cast("int")
        start = F.struct(s.substr(F.lit(1), cut).alias("l"), s.substr(cut + 1, F.length(s) - cut).alias("r"))
        turn = lambda acc, i: F.struct(
            F.when(i % 2 == 1, shifted(acc["l"], acc["r"], i)).otherwise(acc["l"]).alias("l"),
            F.when((i % 2 == 0) & (F.length(acc["r"]) > 0), shifted(acc["r"], acc["l"], i)).otherwise(acc["r"]).alias("r"),
        )
        return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn, lambda acc: F.concat(acc["l"], acc["r"]))

    local, domain = F.substring_index(m, "@", 1), F.substring_index(m, "@", -1)

    def spell(new: Column) -> Column:
        known = lambda i: F.length(F.regexp_replace(local.substr(F.lit(1), i), "[^A-Za-z0-9]", ""))
        return F.concat(F.array_join(F.transform(F.sequence(F.lit(1), F.length(local)), lambda i: F.when(
            local.substr(i, F.lit(1)).rlike("[A-Za-z0-9]"), new.substr(known(i), F.lit(1))
        ).otherwise(local.substr(i, F.lit(1)))), ""), F.lit("@"), domain)

    plain = F.regexp_replace(local, "[^A-Za-z0-9]", "")
    return F.when(F.length(plain) > 0, _let(_let(plain, permute), spell))


_CHANGE = {"mail": _mail, "iban": _iban, "ip": _ip, "date": _date, "ssn": _ssn, "phone": _phone}
_PIECES = "array<struct<kind:string,new:string,old:string>>"


def _piece(kind: Column, new: Column, old: Column) -> Column:
    return F.struct(kind.cast("string").alias("kind"), new.cast("string").alias("new"), old.alias("old"))


def _plain(old: Column) -> Column:
    return _piece(F.lit(None), F.lit(None), old)


def pseudonym(key: str, m: Column, kinds: tuple[str, ...] = tuple(_CHANGE)) -> Column:
    """Piece of a candidate; ``new`` is null where it fails its validation, and for a run of digits, of the kind card."""
    chain = None
    for name in kinds:
        case, test = _piece(F.lit(name), _CHANGE[name](key, m), m), m.rlike(_SHAPES[name])
        chain = F.when(test, case) if chain is None else chain.when(test, case)
    return chain.otherwise(_piece(F.lit("card"), F.lit(None), m))


def _pieces(text: Column, pattern: str, use: Callable[[Column], Column]) -> Column:
    """``text`` as pieces in order: the gaps between the candidates, and ``use`` of each candidate."""
    found = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), use)
    return _let(F.struct(F.split(text, pattern, -1).alias("gaps"), found.alias("found")), lambda x: F.flatten(F.transform(
        F.sequence(F.lit(1), F.size(x["gaps"])),
        lambda i: F.when(i <= F.size(x["found"]), F.array(_plain(F.element_at(x["gaps"], i)), F.try_element_at(x["found"], i)))
        .otherwise(F.array(_plain(F.element_at(x["gaps"], i)))),
    )))


def _cards(key: str, run: Column) -> Column:
    """A run of digit groups as pieces: the cards in it, from border to border, and the text between them."""

    def search(groups: Column) -> Column:
        def end(i: Column) -> Column:
            """Last group of the longest card that starts with group ``i``, or null."""
            ends = F.sequence(F.least(i + 18, F.size(groups)), i)
            return F.try_element_at(F.filter(ends, lambda j: _let(
                F.array_join(F.slice(groups, i, j - i + 1), ""),
                lambda d: F.when(d.rlike("^[0-9]{13,19}$"), F.right(d, F.lit(1)) == _check_digit(d.substr(F.lit(1), F.length(d) - 1))).otherwise(False),
            )), F.lit(1))

        def turn(acc: Column, i: Column) -> Column:
            group = F.element_at(groups, i)
            after = acc["at"] + F.length(group) + 1
            starts = (i >= acc["free"]) & group.rlike("^[0-9]+$") & ((i == 1) | (F.length(group) >= 4))
            last = F.when(starts, end(i))
            return _let(last, lambda j: F.when(j.isNull(), F.struct(
                after.alias("at"), acc["free"].alias("free"), acc["done"].alias("done"), acc["out"].alias("out"),
            )).otherwise(_let(F.length(F.array_join(F.slice(groups, i, j - i + 1), " ")), lambda n: F.struct(
                after.alias("at"), (j + 1).alias("free"), (acc["at"] + n).alias("done"),
                F.concat(acc["out"], F.array(
                    _plain(run.substr(acc["done"], acc["at"] - acc["done"])),
                    _piece(F.lit("card"), _card(key, run.substr(acc["at"], n)), run.substr(acc["at"], n)),
                )).alias("out"),
            ))))

        start = F.struct(F.lit(1).alias("at"), F.lit(1).alias("free"), F.lit(1).alias("done"), F.array().cast(_PIECES).alias("out"))
        return F.aggregate(F.sequence(F.lit(1), F.size(groups)), start, turn, lambda acc: F.concat(
            acc["out"], F.array(_plain(run.substr(acc["done"], F.length(run))))))

    return _let(F.split(run, "[ -]"), search)


def _again(pieces: Column, test: Callable[[Column], Column], use: Callable[[Column], Column]) -> Column:
    """``pieces`` with those that pass ``test`` replaced by the pieces ``use`` of their text."""
    return F.flatten(F.transform(pieces, lambda p: F.when(test(p), use(p["old"])).otherwise(F.array(p))))


def pseudonymise(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the rewritten text and the number of replaced values of each kind."""
    text, simple = F.col("text"), ("ip", "date", "ssn", "phone")
    failed = lambda kind: lambda p: (p["kind"] == kind) & p["new"].isNull()

    def runs(run: Column) -> Column:
        rest = lambda p: p["kind"].isNull() & p["old"].rlike("[0-9]")
        return _again(_cards(key, run), rest, lambda t: _pieces(t, SIMPLE, lambda m: pseudonym(key, m, simple)))

    first = _pieces(text, CANDIDATE, lambda m: pseudonym(key, m))
    second = _again(first, failed("iban"), lambda t: _pieces(t, f"{SIMPLE}|{_RUN}", lambda m: pseudonym(key, m, simple)))
    # most texts hold neither a digit nor an at sign: one scan settles them
    found = F.when(text.rlike("[0-9@]"), _again(second, failed("card"), runs)).otherwise(F.array().cast(_PIECES))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).withColumn("found", found)
    rewritten = F.when(F.exists("found", lambda p: p["new"].isNotNull()), F.array_join(
        F.transform("found", lambda p: F.coalesce(p["new"], p["old"])), "")).otherwise(text)
    changed = F.transform(F.filter("found", lambda p: p["new"].isNotNull()), lambda p: p["kind"])
    counts = [
        (F.size(changed) - F.size(F.array_remove(changed, k))).cast("long").alias(f"n_{k}") for k in KINDS
    ]
    return rows.select("doc_id", *counts, rewritten.alias("text"))
