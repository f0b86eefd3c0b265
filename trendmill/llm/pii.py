"""Personal data replaced by keyed pseudonyms of the same format, with SQL functions only.

Validated numbers and dates are permuted within their format by a Feistel network, so one value has
one pseudonym in all documents, no two values share one, and whoever has the key can undo it. Mail
addresses and tokens, whose format has no fixed domain, get keyed digests.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8  # even, so that both halves are changed as often

#: Dates are permuted among FIRST_DAY and the days after it, of which there are HALVES[0] * HALVES[1] (to 2100-05-02).
FIRST_DAY, HALVES = "1900-01-01", (270, 271)

_BYTE = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
#: What a value of each kind looks like, in the order in which they are looked for.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++){1,8}",
    "token": r"(?<![A-Za-z0-9])[0-9a-f]{32,64}(?![A-Za-z0-9])",
    "ip": rf"(?<![0-9A-Za-z.]){_BYTE}(?:\.{_BYTE}){{3}}(?![0-9A-Za-z]|\.[0-9])",
    "date": r"(?<![0-9A-Za-z./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?![0-9A-Za-z/-]|\.[0-9])",
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "phone": r"(?<![0-9A-Za-z+(])(?:\+1[ .-]?\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}|\+[0-9]{8,15}"
    r"|\+[0-9]{1,3}[ -](?:\([0-9]{1,5}\)|[0-9]{1,8})(?:[ -][0-9]{1,8}){1,4}|\([0-9]{3}\)[ .-]?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})(?![0-9A-Za-z]|\.[0-9])",
    "card": r"(?<![0-9A-Za-z-])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3})(?![0-9A-Za-z])",
}
ANY = "|".join(PATTERNS.values())

#: Which of them a match is: its shape is enough, as the patterns have looked at what is around it.
SHAPES = {
    "email": "m LIKE '%@%'",
    "token": "m RLIKE '^[0-9a-f]{32,64}$'",
    "ip": r"m RLIKE '^[0-9]{1,3}([.][0-9]{1,3}){3}$'",
    "date": r"m RLIKE '^([0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}[.][0-9]{2}[.][0-9]{4})$'",
    "ssn": r"m RLIKE '^[0-9]{3}-[0-9]{2}-[0-9]{4}$'",
    "phone": r"m RLIKE '^[+(]|^[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}$'",
    "card": "TRUE",
}


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _feistel(left: str, right: str, a: str, b: str, kind: str, key: str, back: bool = False) -> str:
    """SQL of a permutation of the pairs (l, r) with 0 <= l < a and 0 <= r < b, as a struct of both.

    In turns l and r are moved round by a keyed digest (SHA-256, 60 bits) of the other.
    """

    def moved(half: str, other: str, size: str) -> str:
        digest = f"sha2(concat_ws(':', {_quoted(key)}, '{kind}', {size}, k, s.{other}), 256)"
        by = f"CAST(conv(left({digest}, 15), 16, 10) AS BIGINT)"
        return f"pmod(s.{half} {'-' if back else '+'} pmod({by}, {size}), {size})"

    order = f"sequence({ROUNDS}, 1, -1)" if back else f"sequence(1, {ROUNDS})"
    return f"""aggregate({order}, named_struct('l', CAST({left} AS BIGINT), 'r', CAST({right} AS BIGINT)),
        (s, k) -> IF(k % 2 = 1, named_struct('l', {moved('l', 'r', a)}, 'r', s.r),
                                named_struct('l', s.l, 'r', {moved('r', 'l', b)})))"""


def _power(n: str) -> str:
    return f"CAST(pow(10, {n}) AS BIGINT)"


def _digits_permuted(digits: str, kind: str, key: str, back: bool) -> str:
    """SQL for the digits of the same number that a string of 2 to 18 digits is permuted to."""
    n = f"length({digits})"
    half = f"CAST({n} DIV 2 AS INT)"
    pair = _feistel(f"left({digits}, {half})", f"substr({digits}, {half} + 1)", _power(half), _power(f"({n} - {half})"), kind, key, back)
    return f"transform(array({pair}), p -> concat(lpad(CAST(p.l AS STRING), {half}, '0'), lpad(CAST(p.r AS STRING), {n} - {half}, '0')))[0]"


def _put_back(match: str, digits: str) -> str:
    """SQL for ``match`` with its digits replaced by ``digits``, one by one, and all else as it was."""
    place = f"length(regexp_replace(left({match}, i), '[^0-9]', ''))"
    char = f"substr({match}, i, 1)"
    return f"""transform(array({digits}), d -> array_join(transform(sequence(1, length({match})), i ->
        IF({char} BETWEEN '0' AND '9', substr(d, {place}, 1), {char})), ''))[0]"""


def _luhn(digits: str) -> str:
    """SQL for the Luhn sum of a string of digits, whose last one is the check digit."""
    return f"""aggregate(sequence(1, length({digits})), 0, (t, i) -> t + transform(
        array(CAST(substr({digits}, length({digits}) + 1 - i, 1) AS INT) * IF(i % 2 = 0, 2, 1)), v -> IF(v > 9, v - 9, v))[0])"""


def _pseudonym(kind: str, key: str, back: bool) -> str:
    """SQL for what the match m of a kind is replaced by, and null where it is not valid."""
    plain = "regexp_replace(m, '[^0-9]', '')"
    digest = f"sha2(concat_ws(':', {_quoted(key)}, '{kind}', m), 256)"
    if kind == "email":
        return "m" if back else f"concat(left({digest}, 12), '@', substr({digest}, 13, 8), '.invalid')"
    if kind == "token":
        return "m" if back else f"left({digest}, length(m))"
    if kind == "ip":
        parts = "transform(split(m, '[.]'), x -> CAST(x AS BIGINT))"
        pair = _feistel("p[0] * 256 + p[1]", "p[2] * 256 + p[3]", "65536L", "65536L", kind, key, back)
        return f"""transform(transform(array({parts}), p -> {pair}), x -> concat_ws('.',
            x.l DIV 256, x.l % 256, x.r DIV 256, x.r % 256))[0]"""
    if kind == "date":
        a, b = HALVES
        form = "CASE WHEN m LIKE '%-%' THEN 'yyyy-MM-dd' WHEN m LIKE '%.%' THEN 'dd.MM.yyyy' WHEN try_to_date(m, 'dd/MM/yyyy') IS NULL THEN 'MM/dd/yyyy' ELSE 'dd/MM/yyyy' END"
        day = f"datediff(try_to_date(m, f), DATE'{FIRST_DAY}')"
        pair = _feistel(f"n DIV {b}", f"n % {b}", f"{a}L", f"{b}L", kind, key, back)
        moved = f"transform(transform(array(n), n -> {pair}), x -> date_format(date_add(DATE'{FIRST_DAY}', CAST(x.l * {b} + x.r AS INT)), f))[0]"
        return f"transform(transform(array({form}), f -> named_struct('f', f, 'n', {day})), t -> IF(t.n BETWEEN 0 AND {a * b - 1}, {moved.replace('array(n)', 'array(t.n)').replace(', f)', ', t.f)')}, NULL))[0]"
    if kind == "ssn":  # area 001 to 899 but 666, group 01 to 99, number 0001 to 9999
        area, group, number = "CAST(left(m, 3) AS BIGINT)", "CAST(substr(m, 5, 2) AS BIGINT)", "CAST(right(m, 4) AS BIGINT)"
        valid = f"{area} BETWEEN 1 AND 899 AND {area} != 666 AND {group} > 0 AND {number} > 0"
        left = f"({area} - 1 - IF({area} > 666, 1, 0)) * 99 + {group} - 1"
        pair = _feistel(left, f"{number} - 1", "88902L", "9999L", kind, key, back)
        shown = "concat_ws('-', lpad(CAST(x.l DIV 99 + 1 + IF(x.l DIV 99 >= 665, 1, 0) AS STRING), 3, '0'), lpad(CAST(x.l % 99 + 1 AS STRING), 2, '0'), lpad(CAST(x.r + 1 AS STRING), 4, '0'))"
        return f"IF({valid}, transform(array({pair}), x -> {shown})[0], NULL)"
    if kind == "phone":  # a country code stays as it is
        code = "regexp_extract(m, '^[+][0-9]{1,3}?(?=[ .(-])|^[+][0-9]', 0)"
        rest = "substr(m, length(c) + 1)"
        own = "regexp_replace(substr(m, length(c) + 1), '[^0-9]', '')"
        moved = _put_back(rest, _digits_permuted("d", kind, key, back).join(("transform(array(" + own + "), d -> ", ")[0]")))
        return f"IF(length({plain}) BETWEEN 8 AND 18, transform(array({code}), c -> concat(c, {moved}))[0], NULL)"
    body = f"left({plain}, length({plain}) - 1)"
    moved = _digits_permuted("d", kind, key, back)
    whole = f"transform(transform(array({body}), d -> {moved}), d -> concat(d, CAST(pmod(10 - {_luhn('concat(d, 0)')} % 10, 10) AS STRING)))[0]"
    return f"IF({_luhn(plain)} % 10 = 0, {_put_back('m', whole)}, NULL)"


def _cases(key: str, back: bool) -> str:
    return "CASE " + " ".join(f"WHEN {SHAPES[kind]} THEN {_pseudonym(kind, key, back)}" for kind in PATTERNS) + " END"


def replaced(text: str, key: str, back: bool = False) -> Column:
    """A struct for the text column: text, with pseudonyms; n_matches; n_replaced, of the valid ones.

    A text without an @ or a digit is returned without a search. Null stays null with counts of zero.
    """
    matches = f"IF({text} RLIKE '[0-9@]', regexp_extract_all({text}, {_quoted(ANY)}, 0), CAST(array() AS array<string>))"
    parts = f"split({text}, {_quoted(ANY)}, -1)"
    return F.expr(
        f"""transform(array(COALESCE({matches}, CAST(array() AS array<string>))), found ->
            transform(array(transform(found, m -> {_cases(key, back)})), new -> named_struct(
                'text', IF(size(found) = 0, {text}, array_join(zip_with({parts},
                    transform(sequence(0, size(found) - 1), i -> COALESCE(new[i], found[i])),
                    (part, put) -> concat(part, COALESCE(put, ''))), '')),
                'n_matches', size(found),
                'n_replaced', size(filter(new, x -> x IS NOT NULL))))[0])[0]"""
    )


def pseudonymised(docs: DataFrame, key: str, text_column: str = "text", back: bool = False) -> DataFrame:
    """``docs`` with pseudonyms in the text column and all other columns as they are.

    key: a secret; the same key gives the same pseudonyms, and ``back`` undoes those of numbers and
    dates (but for dates written month first, whose pseudonym may also be read day first). Cards must pass Luhn's check and get a new check digit; dates must exist and lie within
    the range of FIRST_DAY; social security numbers must be of an area that was given out;
    telephone numbers have 8 to 18 digits and keep their country code. What is not valid stays.
    """
    new = replaced(f"`{text_column}`", key, back)["text"]
    return docs.select(*[new.alias(name) if name == text_column else F.col(f"`{name}`") for name in docs.columns])
