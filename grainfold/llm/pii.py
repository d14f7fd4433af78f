"""Format-preserving pseudonyms: personal numbers, dates and addresses are permuted under a key within their format.

Each value goes through a Feistel network whose rounds add a keyed hash of one half to the
other, position by position or as numbers below a fixed bound. That is a bijection of each
format: equal values get equal pseudonyms in all documents, different ones stay different,
and whoever has the key can undo it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainfold.llm.common import fresh_name

ROUNDS = 8
#: Length of an IBAN by country.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
_IBANS = "|".join(rf"(?:{c.replace(' ', '|')})\d{{2}}(?: ?[A-Z0-9]{{4}}){{{n // 4 - 1}}}" + (rf" ?[A-Z0-9]{{{n % 4}}}" if n % 4 else "") for n, c in IBAN_LENGTHS.items())
#: What begins another value isn't part of the phone number before it.
_NEXT = r"(?! (?:\d{4}[ -]\d{4}[ -]\d{4}|\d{13}|\d{4}-\d{2}-\d{2}|\d{3}-\d{2}-\d{4}|\d{1,3}\.\d{1,3}\.\d|\d{2}[./]\d{2}[./]\d|\(?\d{3}\)?[ .-]\d{3}[ .-]\d{4}(?!\w)))"
#: The forms a candidate may have, in the order in which they are tried.
FORMS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "iban": rf"(?<!\w)(?:{_IBANS})(?!\w)|(?<!\w)[A-Z]{{2}}\d{{2}}(?: ?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,3}})?(?!\w)",
    "iso_date": r"(?<![\w-])\d{4}-\d{2}-\d{2}(?![\w-])",
    "slash_date": r"(?<![\w/])\d{2}/\d{2}/\d{4}(?![\w/])",
    "dot_date": r"(?<![\w.])\d{2}\.\d{2}\.\d{4}(?!\w|\.\d)",
    "ipv4": r"(?<![\w.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\w|\.\d)",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "phone": r"(?<!\w)(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\)[ .-]?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\w)"
    rf"|(?<!\w)\+\d(?:{_NEXT}(?:[ .-]?\(|\)[ .-]?|[ ./-])?\d){{6,14}}(?!\w)|(?<![\w.-])[2-9]\d{{9}}(?![\w-]|\.\d)",
    "card": r"(?<![\w-])\d(?:[ -]?\d){12,18}(?![\w-])",
}
CANDIDATES = "|".join(FORMS.values())
#: Dates are permuted within 270 x 270 days from this one on, up to 4 August 2099.
FIRST_DAY, DAY_RADIX = "1900-01-01", 270
#: Looks again at what values leave of their candidates, and most tries for a pseudonym that is found in the same place.
AGAIN, TRIES = 2, 40


def _noise(secret: str, form: str, *parts: Column) -> Column:
    """60 bits of a keyed hash as long."""
    digest = F.sha2(F.concat_ws("|", F.lit(secret), F.lit(form), *[p.cast("string") for p in parts]).cast("binary"), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def _rounds(undo: bool) -> Column:
    return F.array(*[F.lit(i) for i in (reversed(range(ROUNDS)) if undo else range(ROUNDS))])


def permute_pair(left: Column, right: Column, radices: tuple[int, int], secret: str, form: str, undo: bool) -> Column:
    """Feistel network on two numbers below their radices; gives a struct of ``l`` and ``r``."""
    sign = -1 if undo else 1

    def turn(state: Column, i: Column) -> Column:
        left, right = state["l"], state["r"]
        return F.when(i % 2 == 0, F.struct(F.pmod(left + sign * (_noise(secret, form, i, right) % radices[0]), F.lit(radices[0])).alias("l"), right.alias("r"))).otherwise(
            F.struct(left.alias("l"), F.pmod(right + sign * (_noise(secret, form, i, left) % radices[1]), F.lit(radices[1])).alias("r"))
        )

    return F.aggregate(_rounds(undo), F.struct(left.cast("long").alias("l"), right.cast("long").alias("r")), turn)


def _shifted(text: Column, other: Column, i: Column, secret: str, form: str, sign: int) -> Column:
    """Letters and digits of ``text`` moved within their kind by keyed hashes of ``other`` and their place."""

    def move(char: Column, place: Column) -> Column:
        by = sign * (_noise(secret, form, i, other, place) % 260)
        code = F.ascii(char)

        def within(first: int, n: int) -> Column:
            return F.char(F.lit(first) + F.pmod(code - first + by, F.lit(n)))

        return F.when(char.between("0", "9"), within(48, 10)).when(char.between("a", "z"), within(97, 26)).when(char.between("A", "Z"), within(65, 26)).otherwise(char)

    return F.array_join(F.transform(F.filter(F.split(text, ""), lambda c: c != ""), move), "")


def permute_text(text: Column, secret: str, form: str, undo: bool) -> Column:
    """Feistel network on a string of any length: digits stay digits, letters stay letters of their case."""
    half = F.floor(F.length(text) / 2).cast("int")
    start = F.struct(F.substring(text, F.lit(1), half).alias("l"), F.substring(text, half + 1, F.length(text)).alias("r"))
    sign = -1 if undo else 1

    def turn(state: Column, i: Column) -> Column:
        left, right = state["l"], state["r"]
        return F.when(i % 2 == 0, F.struct(_shifted(left, right, i, secret, form, sign).alias("l"), right.alias("r"))).otherwise(
            F.struct(left.alias("l"), _shifted(right, left, i, secret, form, sign).alias("r"))
        )

    end = F.aggregate(_rounds(undo), start, turn)
    return F.concat(end["l"], end["r"])


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, r"\D", "")


def _refill(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced by ``digits`` in order."""
    chars = F.filter(F.split(shape, ""), lambda c: c != "")
    start = F.struct(F.lit("").alias("t"), F.lit(1).alias("n"))

    def step(state: Column, char: Column) -> Column:
        digit = char.between("0", "9")
        return F.struct(F.concat(state["t"], F.when(digit, F.substring(digits, state["n"], F.lit(1))).otherwise(char)).alias("t"), (state["n"] + digit.cast("int")).alias("n"))

    return F.aggregate(chars, start, step)["t"]


def _mod97(text: Column) -> Column:
    """Remainder by 97 of digits and capital letters, a letter counting as two digits from 10 on."""

    def step(rest: Column, char: Column) -> Column:
        code = F.ascii(char)
        return F.when(code < 58, (rest * 10 + code - 48) % 97).otherwise((rest * 100 + code - 55) % 97)

    return F.aggregate(F.filter(F.split(text, ""), lambda c: c != ""), F.lit(0), step)


def _day(value: Column, form: str) -> Column:
    """Days since the first day, null outside the range of dates; also null for dates that don't exist."""
    pattern = {"iso_date": "yyyy-MM-dd", "dot_date": "dd.MM.yyyy", "slash_date": "dd/MM/yyyy", "slash_us": "MM/dd/yyyy"}[form]
    day = F.datediff(F.to_date(F.try_to_timestamp(value, F.lit(pattern))), F.lit(FIRST_DAY).cast("date"))
    return F.when(day.between(0, DAY_RADIX * DAY_RADIX - 1), day)


def _date(value: Column, form: str, secret: str, undo: bool) -> Column:
    pattern = {"iso_date": "yyyy-MM-dd", "dot_date": "dd.MM.yyyy", "slash_date": "dd/MM/yyyy", "slash_us": "MM/dd/yyyy"}[form]
    day = _day(value, form)
    end = permute_pair(F.floor(day / DAY_RADIX), day % DAY_RADIX, (DAY_RADIX, DAY_RADIX), secret, "date", undo)
    return F.date_format(F.date_add(F.lit(FIRST_DAY).cast("date"), (end["l"] * DAY_RADIX + end["r"]).cast("int")), pattern)


def _card(value: Column, secret: str, undo: bool) -> Column:
    digits = _digits(value)
    body = permute_text(F.substring(digits, F.lit(1), F.length(digits) - 1), secret, "card", undo)
    check = F.filter(F.array(*[F.lit(str(d)) for d in range(10)]), lambda d: F.call_function("luhn_check", F.concat(body, d)))
    return _refill(value, F.concat(body, F.get(check, F.lit(0))))


def _iban(value: Column, secret: str, undo: bool) -> Column:
    plain = F.replace(value, F.lit(" "), F.lit(""))
    country, account = F.substring(plain, 1, 2), F.substring(plain, F.lit(5), F.length(plain))
    moved = permute_text(account, secret, "iban", undo)
    check = F.lpad((98 - _mod97(F.concat(moved, country, F.lit("00")))).cast("string"), 2, "0")
    whole = F.concat(country, check, moved)
    # blanks go back where they were
    chars = F.filter(F.split(value, ""), lambda c: c != "")
    start = F.struct(F.lit("").alias("t"), F.lit(1).alias("n"))

    def step(state: Column, char: Column) -> Column:
        blank = char == " "
        return F.struct(F.concat(state["t"], F.when(blank, char).otherwise(F.substring(whole, state["n"], F.lit(1)))).alias("t"), (state["n"] + (~blank).cast("int")).alias("n"))

    return F.aggregate(chars, start, step)["t"]


def _ssn_parts(value: Column) -> tuple[Column, Column, Column]:
    return tuple(F.get(F.split(value, "-"), F.lit(i)).cast("int") for i in range(3))


def _ssn(value: Column, secret: str, undo: bool) -> Column:
    area, group, serial = _ssn_parts(value)
    area = area - 1 - (area > 666).cast("int")  # 898 areas: 1 to 899 without 666
    end = permute_pair(area * 99 + group - 1, serial - 1, (898 * 99, 9999), secret, "ssn", undo)
    new_area = F.floor(end["l"] / 99) + 1
    new_area = new_area + (new_area >= 666).cast("int")
    return F.format_string("%03d-%02d-%04d", new_area, end["l"] % 99 + 1, end["r"] + 1)


def _ipv4(value: Column, secret: str, undo: bool) -> Column:
    part = [F.get(F.split(value, r"\."), F.lit(i)).cast("int") for i in range(4)]
    end = permute_pair(part[0] * 256 + part[1], part[2] * 256 + part[3], (65536, 65536), secret, "ipv4", undo)
    return F.concat_ws(".", *[(F.floor(half / 256)).cast("string") if high else (half % 256).cast("string") for half in (end["l"], end["r"]) for high in (True, False)])


def _phone(value: Column, secret: str, undo: bool) -> Column:
    """The last ten digits are moved, of longer numbers all but three, of shorter ones with a plus all but one."""
    digits = _digits(value)
    n = F.length(digits)
    kept = F.when(n > 10, F.least(n - 10, F.lit(3))).when(value.startswith("+"), 1).otherwise(0)
    moved = permute_text(F.substring(digits, kept + 1, n), secret, "phone", undo)
    return _refill(value, F.concat(F.substring(digits, F.lit(1), kept), moved))


def _email(value: Column, secret: str, undo: bool) -> Column:
    local, domain = F.substring_index(value, "@", 1), F.substring_index(value, "@", -1)
    return F.concat(permute_text(local, secret, "email", undo), F.lit("@"), domain)


def _kind(value: Column) -> Column:
    """Form of a candidate that passes its check, else null."""
    area, group, serial = _ssn_parts(value)
    octets = F.split(value, r"\.")
    plain = F.replace(value, F.lit(" "), F.lit(""))
    rotated = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))
    whole = {name: value.rlike(f"^(?:{form})$") for name, form in FORMS.items()}
    return (
        F.when(whole["email"], "email")
        .when(whole["iban"], F.when(_mod97(rotated) == 1, "iban"))
        .when(whole["iso_date"], F.when(_day(value, "iso_date").isNotNull(), "iso_date"))
        .when(whole["slash_date"], F.when(_day(value, "slash_date").isNotNull(), "slash_date").when(_day(value, "slash_us").isNotNull(), "slash_us"))
        .when(whole["dot_date"], F.when(_day(value, "dot_date").isNotNull(), "dot_date"))
        .when(whole["ipv4"], F.when(F.forall(octets, lambda o: o.cast("int") <= 255), "ipv4"))
        .when(whole["ssn"], F.when((area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0), "ssn"))
        .when(whole["phone"], "phone")
        .when(whole["card"], F.when(F.call_function("luhn_check", _digits(value)), "card"))
    )


def _spans(value: Column, marks: str) -> Column:
    """Runs of whole groups of a candidate as structs of ``at`` (characters before) and ``v``, cut at blanks only; ``small`` says whether a group has less than three characters."""
    groups = F.split(value, marks)
    n = F.size(groups)
    starts = F.transform(F.sequence(F.lit(0), n), lambda i: F.aggregate(F.slice(groups, F.lit(1), i), F.lit(0), lambda length, g: length + F.length(g) + 1))

    def run(i: Column, j: Column) -> Column:
        at, end = F.get(starts, i), F.get(starts, j)
        cut = ((i == 0) | (F.substring(value, at, F.lit(1)) == " ")) & ((j == n) | (F.substring(value, end, F.lit(1)) == " "))
        small = F.exists(F.slice(groups, i + 1, j - i), lambda g: F.length(g) < 3)
        return F.struct(at.alias("at"), F.substring(value, at + 1, end - at - 1).alias("v"), cut.alias("cut"), small.alias("small"))

    every = F.flatten(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.transform(F.sequence(i + 1, n), lambda j: run(i, j))))
    return F.filter(every, lambda s: s["cut"])


def _longest(spans: Column, kind: str) -> Column:
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct((-F.length(s["v"])).alias("n"), s["at"].alias("at"), s["v"].alias("v"))))
    best = F.get(ordered, F.lit(0))
    return F.when(best.isNotNull(), F.struct(best["at"].alias("at"), best["v"].alias("v"), F.lit(kind).alias("k")))


def _fit(value: Column) -> Column:
    """The value in a candidate: struct of ``at`` (characters before it), ``v`` and its form ``k``, which is null if there is none.

    That is the whole candidate if it passes its check; else, of cards and of IBANs of countries whose length isn't known, the longest
    run of its groups that does.
    """
    whole = F.struct(F.lit(0).alias("at"), value.alias("v"), _kind(value).alias("k"))

    def right_card(span: Column) -> Column:
        digits = _digits(span["v"])
        return ~span["small"] & F.length(digits).between(13, 19) & F.call_function("luhn_check", digits)

    def right_iban(span: Column) -> Column:
        plain = F.replace(span["v"], F.lit(" "), F.lit(""))
        return (span["at"] == 0) & span["v"].rlike(f"^(?:{FORMS['iban']})$") & (_mod97(F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))) == 1)

    def if_whole(w: Column) -> Column:
        known = F.substring(value, 1, 2).isin(*" ".join(IBAN_LENGTHS.values()).split())
        card = F.when(value.rlike(f"^(?:{FORMS['card']})$"), _longest(F.filter(_spans(value, "[ -]"), right_card), "card"))
        iban = F.when(value.rlike(f"^(?:{FORMS['iban']})$") & ~known, _longest(F.filter(_spans(value, " "), right_iban), "iban"))
        return F.when(w["k"].isNotNull(), w).otherwise(F.coalesce(card, iban, w))

    return _let(whole, if_whole)


def _let(value: Column, then) -> Column:
    """``then(value)`` with ``value`` worked out once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _replaced(candidate: Column, fit: Column, secret: str, undo: bool) -> Column:
    """Pseudonym of the value in a candidate, from the same place of which it is read again.

    A pseudonym that would be read as another form or together with other groups of the candidate is moved on until it isn't (cycle walking,
    which keeps the bijection).
    """
    before = F.substring(candidate, F.lit(1), fit["at"])
    after = F.substring(candidate, fit["at"] + F.length(fit["v"]) + 1, F.length(candidate))

    whole = (fit["at"] == 0) & (F.length(fit["v"]) == F.length(candidate))
    plain = whole & ~((fit["k"] == "phone") & candidate.rlike("^[0-9]+$"))

    def step(state: Column, _: Column) -> Column:
        def check(new: Column) -> Column:
            same = _let(F.concat(before, new, after), lambda m: _let(_fit(m), lambda f: (f["at"] == fit["at"]) & (F.length(f["v"]) == F.length(new)) & f["k"].eqNullSafe(fit["k"])))
            return F.struct(new.alias("v"), (plain | same).alias("ok"))

        return F.when(state["ok"], state).otherwise(_let(_pseudonym(state["v"], fit["k"], secret, undo), check))

    walked = F.aggregate(F.sequence(F.lit(1), F.lit(TRIES)), F.struct(fit["v"].alias("v"), F.lit(False).alias("ok")), step)["v"]
    return F.when(fit["k"].isNull(), fit["v"]).otherwise(walked)


def _pieces(text: Column, secret: str, undo: bool) -> Column:
    """A text as an array of structs: ``s`` and ``n``, which is 1 for a pseudonym, -1 for text to be looked at again, else 0."""
    found = F.transform(F.regexp_extract_all(text, F.lit(CANDIDATES), F.lit(0)), lambda m: F.struct(m.alias("m"), _fit(m).alias("f")))

    def cut(found: Column) -> Column:
        def piece(gap: Column, i: Column) -> Column:
            here, last = F.get(found, i), F.get(found, i - 1)
            rest = F.coalesce(F.substring(last["m"], last["f"]["at"] + F.length(last["f"]["v"]) + 1, F.length(last["m"])), F.lit(""))
            head = F.coalesce(F.substring(here["m"], F.lit(1), here["f"]["at"]), F.lit(""))
            value = F.coalesce(F.when(here.isNotNull(), _replaced(here["m"], here["f"], secret, undo)), F.lit(""))
            return F.array(
                F.struct(F.concat(rest, gap, head).alias("s"), F.when(rest != "", -1).otherwise(0).alias("n")),
                F.struct(value.alias("s"), F.when(here["f"]["k"].isNotNull(), 1).otherwise(0).alias("n")),
            )

        return F.flatten(F.transform(F.split(text, CANDIDATES, -1), piece))

    return _let(found, cut)


def _pseudonym(value: Column, kind: Column, secret: str, undo: bool) -> Column:
    new = F.when(kind == "email", _email(value, secret, undo)).when(kind == "iban", _iban(value, secret, undo))
    for form in ("iso_date", "slash_date", "slash_us", "dot_date"):
        new = new.when(kind == form, _date(value, form, secret, undo))
    return (
        new.when(kind == "ipv4", _ipv4(value, secret, undo))
        .when(kind == "ssn", _ssn(value, secret, undo))
        .when(kind == "phone", _phone(value, secret, undo))
        .when(kind == "card", _card(value, secret, undo))
        .otherwise(value)
    )


def pseudonymise(docs: DataFrame, secret: str, text: str = "text", undo: bool = False) -> DataFrame:
    """``docs`` with personal values in ``text`` replaced, and ``n_pseudonyms``: how many there were.

    Found are e-mail addresses (the part before the @ is permuted), phone numbers (groups of 3, 3 and 4 digits, a plus and 7 to 15 digits, or ten
    digits from 2000000000 on), payment cards that pass the Luhn check, IBANs with a right check number, also with other groups of digits or words behind them, US social security numbers in use, IPv4
    addresses, and existing dates from 1900 to August 2099. What fails its check stays as it is, and so does
    all other text. Check digits are worked out anew, so a pseudonym passes the same checks. Equal
    values link across documents, dates also across forms. Slashed dates are read day first where that is
    a date. ``undo`` reverses the replacement with the same ``secret``, except that slashed dates
    may be read in the other order.

    Null texts stay null with 0 pseudonyms, texts without candidates stay the same; texts of any length are taken whole; all rows, repeated ones
    too, and all columns are kept, except that a column called ``n_pseudonyms`` is replaced. An empty table stays empty.
    """
    value = F.col(text)
    maybe = F.coalesce(value.rlike("[0-9@]"), F.lit(False))
    start = F.array(F.struct(value.alias("s"), F.lit(-1).alias("n")))
    looked = F.aggregate(
        F.sequence(F.lit(0), F.lit(AGAIN)), start,
        lambda pieces, _: F.flatten(F.transform(pieces, lambda p: F.when(p["n"] < 0, _pieces(p["s"], secret, undo)).otherwise(F.array(p)))),
    )
    own = fresh_name(docs, "_pii")
    rows = docs.withColumn(own, F.when(maybe, looked))
    count = F.coalesce(F.size(F.filter(own, lambda p: p["n"] > 0)), F.lit(0)).cast("long")
    merged = F.array_join(F.transform(own, lambda p: p["s"]), "")
    return rows.withColumn(text, F.when(F.exists(own, lambda p: p["n"] > 0), merged).otherwise(value)).withColumn("n_pseudonyms", F.greatest(count, F.lit(0).cast("long"))).drop(own)
