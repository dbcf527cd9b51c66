"""Format-preserving pseudonyms: a keyed Feistel permutation per kind of value.

A value becomes a row of symbols, each with a modulus: a digit has 10, an octet
256, a letter 26, a sign that must stay has 1. The symbols are split in two
halves; in each round every symbol of one half is shifted by a keyed hash of the
other half. That is a permutation of the format, so equal values keep equal
pseudonyms in every document, different values never meet, and the holder of the
key can invert it.

Numbers and dates count only if valid: a card number passes its check digit, an
octet is at most 255, a date exists. The pseudonym is valid in the same way.

Numbers side by side are one run; which of its groups are a value, the layouts of
cards and the check sum decide. So the key's holder gets every text back, save
where groups of a run overlap in two ways as a card: a pseudonym can make the
other way pass its check sum too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import free_name

ROUNDS = 8

# Java patterns. No alternative can start inside a word, so none is tried twice
# over the same letters.
_PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "secret": r"AKIA[0-9A-Z]{16}|(?<=password=)[0-9A-Za-z]{8,}|[0-9a-f]{40}",
    "date": r"\d{4}-\d{2}-\d{2}|\d{2}/\d{2}/\d{4}|\d{2}\.\d{2}\.\d{4}",
    "ip": r"\d{1,3}(?:\.\d{1,3}){3}",
    "ssn": r"\d{3}-\d{2}-\d{4}",
    "phone": r"(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}",
    "card": r"\d(?:[ -]?\d){12,18}",
}
# Values that a run of numbers must not reach into: those with other signs in them.
_OTHER_SIGNS = (
    r"(?:(?:\d{1,3}(?:\.\d{1,3}){3}|\d{2}/\d{2}/\d{4}|\d{2}\.\d{2}\.\d{4}"
    r"|\d{3}\.\d{3}[ .-]\d{4}|\d{3}[ -]\d{3}\.\d{4})(?![A-Za-z0-9])"
    r"|\d{4}-\d{2}-\d{2}T\d)"
)
# A date that a time follows, as in 2024-05-01T10:00.
_DATE_WITH_TIME = r"\d{4}-\d{2}-\d{2}(?=T\d{2})"
# Groups of digits that may hold a card, with 13 digits or more. Its loop is
# possessive, so that a long run needs no deep stack.
_RUN = (
    rf"(?=\d(?:[ -]?\d){{12}})(?!{_OTHER_SIGNS})\d++(?![A-Za-z0-9])"
    rf"(?:(?:-| (?!{_PATTERNS['email']}))(?!{_OTHER_SIGNS})\d++(?![A-Za-z0-9]))*+"
)
_FIRST = ("email", "secret")
_ANY = (
    rf"(?<![A-Za-z0-9])(?:{_DATE_WITH_TIME}|(?:"
    + "|".join([*(_PATTERNS[k] for k in _FIRST), _RUN, *(p for k, p in _PATTERNS.items() if k not in _FIRST)])
    + r")(?![A-Za-z0-9]))"
)
_LAYOUTS = r"^(?:\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{4}|\d{4}([ -])\d{6}\2\d{5})$"
_HINT = r"[0-9]|@|password=|AKIA"
_DATE_FORMATS = {
    r"^\d{4}-": "yyyy-MM-dd",
    r"^\d{2}/": "dd/MM/yyyy",
    r"^\d{2}\.": "dd.MM.yyyy",
}
# 270 * 271 days from 1900-01-01, to 2100-05-01.
_DAY_MODULI = (270, 271)
_FIRST_DAY = "1900-01-01"
# Years of a date with the month first, 1900 to 2099, and its days from the 29th on.
_FIRST_YEAR, _YEARS = 1900, 200
_LATE_DAYS = tuple(
    f"{month:02d}/{day}" for month in (1, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12)
    for day in (29, 30, 31) if day < 31 or month not in (4, 6, 9, 11)
)


def _keyed(key: str | Column) -> Column:
    return key if isinstance(key, Column) else F.lit(key)


def _bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def _symbol(value, modulus, base) -> Column:
    as_int = lambda x: (x if isinstance(x, Column) else F.lit(x)).cast("int")
    return F.struct(
        as_int(value).alias("v"), as_int(modulus).alias("m"), as_int(base).alias("base")
    )


def _char_symbol(c: Column) -> Column:
    code = F.ascii(c)
    return (
        F.when(c.between("0", "9"), _symbol(code - 48, 10, 48))
        .when(c.between("a", "z"), _symbol(code - 97, 26, 97))
        .when(c.between("A", "Z"), _symbol(code - 65, 26, 65))
        .otherwise(_symbol(0, 1, code))
    )


def _chars(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def _spell(symbols: Column) -> Column:
    return F.array_join(F.transform(symbols, lambda s: F.char(s["base"] + s["v"])), "")


def feistel(symbols: Column, key: str | Column, tweak: str, invert: bool = False) -> Column:
    """The symbols permuted under ``key``; ``tweak`` keeps kinds of values apart."""
    half = (F.size(symbols) / 2).cast("int")

    def shifted(part: Column, other: Column, i: Column) -> Column:
        values = F.array_join(F.transform(other, lambda s: s["v"].cast("string")), ",")

        def one(s: Column, j: Column) -> Column:
            digest = F.sha2(F.concat_ws("|", _keyed(key), F.lit(tweak), i, j, values), 256)
            step = F.conv(F.substring(digest, 1, 12), 16, 10).cast("long")
            return _symbol(F.pmod(s["v"] + (-step if invert else step), s["m"]), s["m"], s["base"])

        return F.transform(part, one)

    def round_(state: Column, i: Column) -> Column:
        if invert:
            return F.struct(shifted(state.r, state.l, i).alias("l"), state.l.alias("r"))
        return F.struct(state.r.alias("l"), shifted(state.l, state.r, i).alias("r"))

    start = F.struct(
        F.slice(symbols, F.lit(1), half).alias("l"),
        F.slice(symbols, half + 1, F.size(symbols)).alias("r"),
    )
    order = (ROUNDS, 1, -1) if invert else (1, ROUNDS, 1)
    return F.aggregate(
        F.sequence(*map(F.lit, order)), start, round_, lambda end: F.concat(end["l"], end["r"])
    )


def _permute_chars(text: Column, key: str | Column, tweak: str, invert: bool) -> Column:
    return _spell(feistel(F.transform(_chars(text), _char_symbol), key, tweak, invert))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, r"\D", "")


def _into_format(text: Column, digits: Column) -> Column:
    """``text`` with its digits replaced in turn, all else as it is."""
    chars = _chars(text)
    place = lambda i: F.size(
        F.filter(F.slice(chars, F.lit(1), i + 1), lambda c: c.between("0", "9"))
    )
    return F.array_join(
        F.transform(
            chars,
            lambda c, i: F.when(c.between("0", "9"), F.substring(digits, place(i), F.lit(1))).otherwise(c),
        ),
        "",
    )


def _check_sum(digits: Column) -> Column:
    """Luhn sum of a number whose last digit is not doubled."""
    values = F.transform(F.reverse(_chars(digits)), lambda c: c.cast("int"))
    parts = F.transform(
        values,
        lambda v, i: F.when(i % 2 == 0, v).when(v > 4, 2 * v - 9).otherwise(2 * v),
    )
    return F.aggregate(parts, F.lit(0), lambda total, v: total + v)


def _card(text: Column, key: str | Column, invert: bool) -> Column:
    digits = _digits(text)
    body = _permute_chars(F.substring(digits, F.lit(1), F.length(digits) - 1), key, "card", invert)
    check = (10 - _check_sum(F.concat(body, F.lit("0"))) % 10) % 10
    return _into_format(text, F.concat(body, check.cast("string")))


def _tail_digits(text: Column, n: int, key: str | Column, tweak: str, invert: bool) -> Column:
    """The last ``n`` digits permuted; digits before them, as a country code, stay."""
    digits = _digits(text)
    head = F.substring(digits, F.lit(1), F.length(digits) - n)
    tail = _permute_chars(F.substring(digits, -n, n), key, tweak, invert)
    return _into_format(text, F.concat(head, tail))


def _octets(text: Column, key: str | Column, invert: bool) -> Column:
    symbols = F.transform(F.split(text, r"\."), lambda o: _symbol(o, 256, 0))
    return F.array_join(
        F.transform(feistel(symbols, key, "ip", invert), lambda s: s["v"].cast("string")), "."
    )


def _day(text: Column) -> Column:
    """The date that the text names, or null."""
    return F.coalesce(
        *(F.when(text.rlike(p), F.try_to_timestamp(text, F.lit(f)).cast("date")) for p, f in _DATE_FORMATS.items())
    )


def _date(text: Column, key: str | Column, invert: bool) -> Column:
    a, b = _DAY_MODULI
    first = F.lit(_FIRST_DAY).cast("date")

    def symbols(n: Column) -> Column:
        return F.array(_symbol(F.floor(n / b), a, 0), _symbol(n % b, b, 0))

    def spelled(day: Column) -> Column:
        return F.coalesce(
            *(F.when(text.rlike(p), F.date_format(day, f)) for p, f in _DATE_FORMATS.items())
        )

    out = feistel(_bind(F.datediff(_day(text), first), symbols), key, "date", invert)
    day = _bind(out, lambda o: F.date_add(first, o[0]["v"] * b + o[1]["v"]))
    return _bind(day, spelled)


def _us_day(text: Column) -> Column:
    """The date with the month first, where reading the day first gives none; or null."""
    day = F.when(
        text.rlike(r"^\d{2}/") & _day(text).isNull(),
        F.try_to_timestamp(text, F.lit("MM/dd/yyyy")).cast("date"),
    )
    return F.when(F.year(day).between(_FIRST_YEAR, _FIRST_YEAR + _YEARS - 1), day)


def _us_date(text: Column, key: str | Column, invert: bool) -> Column:
    """Such a date becomes such a date, so that it is read alike afterwards.

    Its day is over 12. Days 13 to 28 occur in every month; later ones are
    permuted among themselves, and the 29th of February among leap years.
    """
    two = lambda n: F.lpad(n.cast("string"), 2, "0")
    spelled = lambda head, y: F.concat(head, F.lit("/"), y.cast("string"))
    late_days = F.lit(list(_LATE_DAYS))

    def usual(out: Column) -> Column:
        head = F.concat(two(out[1]["v"] + 1), F.lit("/"), two(out[2]["v"] + 13))
        return spelled(head, out[0]["v"] + _FIRST_YEAR)

    def late(out: Column) -> Column:
        return spelled(F.element_at(late_days, out[1]["v"] + 1), out[0]["v"] + _FIRST_YEAR)

    def permuted(day: Column) -> Column:
        month, of_month = F.month(day) - 1, F.dayofmonth(day)
        year = _symbol(F.year(day) - _FIRST_YEAR, _YEARS, 0)
        early = F.array(year, _symbol(month, 12, 0), _symbol(of_month - 13, 16, 0))
        place = F.array_position(late_days, F.substring(text, 1, 5)) - 1
        others = F.array(year, _symbol(place, len(_LATE_DAYS), 0))
        # 1904 is the first leap year of the range, 2096 the last.
        leap = F.array(_symbol((F.year(day) - _FIRST_YEAR) / 4 - 1, 49, 0))
        of_leap = lambda out: spelled(F.lit("02/29"), out[0]["v"] * 4 + _FIRST_YEAR + 4)
        return (
            F.when(of_month <= 28, _bind(feistel(early, key, "us date", invert), usual))
            .when(month == 1, _bind(feistel(leap, key, "us leap date", invert), of_leap))
            .otherwise(_bind(feistel(others, key, "us late date", invert), late))
        )

    return _bind(_us_day(text), permuted)


def _email(text: Column, key: str | Column, invert: bool) -> Column:
    """Local part and domain apart, so that equal domains stay linked; the last label stays."""
    local, domain = F.split_part(text, F.lit("@"), F.lit(1)), F.split_part(text, F.lit("@"), F.lit(2))
    last = F.regexp_extract(domain, r"\.[A-Za-z]+$", 0)
    body = F.substring(domain, F.lit(1), F.length(domain) - F.length(last))
    return F.concat(
        _permute_chars(local, key, "email", invert),
        F.lit("@"),
        _permute_chars(body, key, "domain", invert),
        last,
    )


def _secret(text: Column, key: str | Column, invert: bool) -> Column:
    """Hexadecimal digits among themselves; of an access key all but its mark."""
    hexadecimal = F.transform(_chars(text), lambda c: _symbol(F.conv(c, 16, 10), 16, 0))
    as_hex = F.array_join(
        F.transform(
            feistel(hexadecimal, key, "hex", invert), lambda s: F.lower(F.hex(s["v"].cast("long")))
        ),
        "",
    )
    kept = F.regexp_extract(text, "^AKIA", 0)
    rest = F.substring(text, F.length(kept) + 1, F.length(text))
    other = F.concat(kept, _permute_chars(rest, key, "secret", invert))
    return F.when(text.rlike("^[0-9a-f]+$"), as_hex).otherwise(other)


def value_kind(text: Column) -> Column:
    """The kind of a matched value; null if it is not valid and must stay."""
    whole = {name: text.rlike(f"^(?:{p})$") for name, p in _PATTERNS.items() if name != "secret"}
    day = F.datediff(_day(text), F.lit(_FIRST_DAY).cast("date"))
    octets = F.forall(F.split(text, r"\."), lambda o: o.cast("int") <= 255)
    return (
        F.when(text.contains("@"), "email")
        .when(
            whole["date"],
            F.when(day.between(0, _DAY_MODULI[0] * _DAY_MODULI[1] - 1), "date").when(
                _us_day(text).isNotNull(), "us date"
            ),
        )
        .when(whole["ip"], F.when(octets, "ip"))
        .when(whole["ssn"], "ssn")
        .when(whole["phone"], "phone")
        .when(text.rlike("[A-Za-z]"), "secret")
        .when(whole["card"], F.when(_check_sum(_digits(text)) % 10 == 0, "card"))
    )


def _values_of_run(run: Column) -> Column:
    """Pairs ``(gap, value)`` that make up a run of groups of digits.

    A value starts and ends with a group. Cards in a usual layout come first, then
    dates and numbers of other kinds, then any 13 to 19 digits that pass the check
    sum, the longest at the first place. Every start is tried.
    """
    valid = lambda text: _check_sum(_digits(text)) % 10 == 0
    whole = "|".join(_PATTERNS[k] for k in ("date", "ssn", "phone"))

    def cut(words: Column) -> Column:
        n = F.size(words)
        joined = lambda i, k: F.array_join(F.slice(words, i, k), "")
        bare = lambda i, k: F.regexp_replace(joined(i, k), "^[ -]", "")
        up_to = lambda k, i: F.least(F.lit(k), n - i + 1)

        def card(i: Column) -> Column:
            fits = lambda k: _bind(bare(i, F.lit(k)), lambda t: t.rlike(_LAYOUTS) & valid(t))
            at = lambda k: (i + (k - 1) <= n) & fits(k)
            return F.when(at(1), 1).when(at(4), 4).when(at(3), 3).otherwise(0)

        def scan(cards: Column) -> Column:
            free = lambda i, k: F.forall(F.slice(cards, i + 1, k - 1), lambda c: c == 0)

            def length(i: Column) -> Column:
                any_card = F.filter(
                    F.sequence(up_to(19, i), F.lit(1), F.lit(-1)),
                    lambda k: F.when(free(i, k), _bind(bare(i, k), lambda t: t.rlike(f"^{_PATTERNS['card']}$") & valid(t))).otherwise(False),
                )
                other = (i + 2 <= n) & free(i, F.lit(3)) & bare(i, F.lit(3)).rlike(f"^(?:{whole})$")
                return F.when(cards[i - 1] > 0, cards[i - 1]).when(other, 3).otherwise(F.coalesce(F.get(any_card, F.lit(0)), F.lit(0)))

            def step(state: Column, i: Column) -> Column:
                def taken(k: Column) -> Column:
                    pair = F.struct(
                        F.concat(
                            joined(state["next"], i - state["next"]), F.regexp_extract(words[i - 1], "^[ -]?", 0)
                        ).alias("gap"),
                        bare(i, k).alias("value"),
                    )
                    return F.when(
                        k > 0,
                        F.struct((i + k).alias("next"), F.concat(state["pairs"], F.array(pair)).alias("pairs")),
                    ).otherwise(state)

                return F.when(i < state["next"], state).otherwise(_bind(length(i), taken))

            start = F.struct(
                F.lit(1).alias("next"), F.array().cast("array<struct<gap:string,value:string>>").alias("pairs")
            )
            return F.aggregate(
                F.sequence(F.lit(1), n),
                start,
                step,
                lambda end: F.concat(
                    end["pairs"],
                    F.array(
                        F.struct(
                            F.array_join(F.slice(words, end["next"], n), "").alias("gap"),
                            F.lit("").alias("value"),
                        )
                    ),
                ),
            )

        return _bind(F.transform(F.sequence(F.lit(1), n), card), scan)

    return _bind(F.regexp_extract_all(run, F.lit(r"[ -]?\d+"), F.lit(0)), cut)


def pseudonym(text: Column, key: str | Column, invert: bool = False) -> Column:
    """The value's pseudonym in its own format, or the value if it is not valid."""

    def of(kind: Column) -> Column:
        return (
            F.when(kind == "email", _email(text, key, invert))
            .when(kind == "date", _date(text, key, invert))
            .when(kind == "us date", _us_date(text, key, invert))
            .when(kind == "ip", _octets(text, key, invert))
            .when(kind == "ssn", _tail_digits(text, 9, key, "ssn", invert))
            .when(kind == "phone", _tail_digits(text, 10, key, "phone", invert))
            .when(kind == "secret", _secret(text, key, invert))
            .when(kind == "card", _card(text, key, invert))
        )

    return F.coalesce(_bind(value_kind(text), of), text)


def pseudonymise(documents: DataFrame, key: str | Column, invert: bool = False) -> DataFrame:
    """``documents`` with pseudonyms in ``text``, and ``n_values``, how many were set.

    Row by row, in the order of the input, no shuffle. A null text stays null
    with 0 values, an empty one empty. Repeated rows change alike. A column
    named ``n_values`` is replaced; all others are carried on. The key is read from
    a table of one row, so that no plan, event log or page of the UI shows it.
    """
    spark = documents.sparkSession
    key_name, found_name, pairs_name = (
        free_name(documents, n) for n in ("pii_key", "pii_found", "pii_pairs")
    )
    secret = spark.createDataFrame([(key,)], f"`{key_name}` string").scalar()
    key = F.col(key_name)
    text = F.col("text").cast("string")
    found = F.when(text.rlike(_HINT), F.regexp_extract_all(text, F.lit(_ANY), F.lit(0)))
    columns = [c for c in documents.columns if c not in ("text", "n_values")]
    columns = [f"`{c}`" for c in columns]
    rows = documents.select(*columns, text.alias("text"), found.alias(found_name))
    # Values are permuted where there are any; most rows only pass.
    some = F.coalesce(F.size(found_name), F.lit(0)) > 0
    pairs = F.flatten(
        F.zip_with(
            F.split("text", _ANY, -1),
            found_name,
            lambda gap, value: F.when(
                value.rlike(r"^\d+[ -][\d -]+$") & (F.length(_digits(value)) >= 13),
                F.concat(
                    F.array(F.struct(gap.alias("gap"), F.lit("").alias("value"))), _values_of_run(value)
                ),
            ).otherwise(F.array(F.struct(gap.alias("gap"), F.coalesce(value, F.lit("")).alias("value")))),
        )
    )
    rows = rows.select(*columns, "text", F.when(some, pairs).alias(pairs_name), secret.alias(key_name))
    some = F.col(pairs_name).isNotNull()
    changed = F.array_join(
        F.transform(pairs_name, lambda p: F.concat(p["gap"], pseudonym(p["value"], key, invert))), ""
    )
    valid = F.size(F.filter(pairs_name, lambda p: value_kind(p["value"]).isNotNull()))
    done = rows.select(
        *columns,
        F.when(some, changed).otherwise(F.col("text")).alias("text"),
        F.when(some, valid).otherwise(0).cast("long").alias("n_values"),
    )
    order = [f"`{c}`" for c in documents.columns]
    return done.select(*order, *({"n_values"} - set(documents.columns)))
