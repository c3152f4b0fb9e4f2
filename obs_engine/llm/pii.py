"""Personal data replaced by format-preserving pseudonyms, by keyed Feistel networks.

Found and checked values are permuted within the values of their kind: cards keep their
length and a right Luhn digit, account numbers a right remainder of 97, dates are real
dates of the same notation, addresses real addresses. A permutation maps equal values to
equal pseudonyms and different ones to different ones, so records stay linked across
documents, and the key's owner can reverse it (``reverse=True``).

Two networks do this, each of ten rounds with SHA-2 of key, kind and round as the round
function: one on pairs of numbers below two bounds, one on the halves of a string whose
positions each have an alphabet. Everything is built-in SQL functions; there is one scan
and no shuffle, and only texts with a digit or one of a few marks are searched.

A secret after a name and a colon counts as one if it has a digit, a sign before a letter,
or is hexadecimal, so that prose after a colon stays; after an equals sign everything
counts. Of a private key the lines between header and footer are permuted.

Edge cases: null and empty texts stay as they are. A value that fails its check (Luhn,
remainder, calendar) is not one of the kind and stays. Passwords, keys and texts may have
any length. Equal values become equal pseudonyms wherever they stand, in repeated rows too.
Other columns pass unchanged. An empty table stays empty.
"""

from __future__ import annotations

import secrets

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obs_engine.llm.common import fresh

ROUNDS = 10

# Characters of an account number by country.
ACCOUNTS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "AO CV GW LY MZ PT ST", 26: "DZ IR IS TR", 27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD",
    28: "AL AZ BF BJ BY CI CY DO EG GT HN HU LB MA ML NE NI PL SN SV TG", 29: "BR PS QA UA", 30: "JO KW MU YE", 31: "MT SC",
    32: "LC", 33: "RU",
}


def account_pattern() -> str:
    """An account ends where its country's ends, whatever follows; other countries' as far as it goes."""
    own = []
    for n, countries in ACCOUNTS.items():
        four, rest = divmod(n - 4, 4)
        own.append(f"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{four}}}" + (f" ?[A-Z0-9]{{{rest}}}" if rest else ""))
    other = "[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?"
    return rf"(?<![A-Za-z0-9])(?:{'|'.join(own)}|{other})(?![A-Za-z0-9])"


# Fixed value: names before a secret.
NAMES = r"(?<![A-Za-z0-9])(?i:passwords?|passwd|passphrase|pwd|client[_-]?secret|secrets?(?:[_-]?key)?|(?:auth|access)[_-]?token|tokens?|(?:api|access|private)[_-]?key)"
# What each kind looks like (Java patterns), tried in this order.
PATTERNS = {
    "email": r"(?<![\w.%+-])[A-Za-z0-9][A-Za-z0-9._%+-]*+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "account": account_pattern(),
    "private": r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]{16,}+",
    "password": NAMES + r" ?(?:=|:(?= ?[\"']?(?:[0-9a-f]{16}|[^\s\"']*[0-9]|[^\s\"']*[!@#$%^&*][A-Za-z]))) ?[\"']?[^\s\"'=:<>][^\s\"']{5,}+",
    "access": r"(?<![A-Za-z0-9])(?:(?:AKIA|ASIA)[A-Z0-9]{16}|gh[opsru]_[A-Za-z0-9]{20,}+|sk-[A-Za-z0-9]{20,}+)(?![A-Za-z0-9])",
    "secret": r"(?<![A-Za-z0-9])(?:[0-9a-f]{32,}+|[0-9A-F]{32,}+)(?![A-Za-z0-9])",
    "date": r"(?<![0-9A-Za-z./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?![0-9A-Za-z])(?![./-][0-9])",
    "address": r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9])(?!\.[0-9])",
    "social": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "card": r"(?<![0-9A-Za-z-])(?:[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{1,7}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}|[0-9]{13,19})(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z+])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,4}){1,4}|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}|[0-9]{3} [0-9]{3} [0-9]{4})(?![0-9A-Za-z])(?! [0-9])",
}
ANY = "|".join(PATTERNS.values())
ALPHABETS = "map('d', '0123456789', 'x', '0123456789abcdef', 'l', 'abcdefghijklmnopqrstuvwxyz', 'u', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'h', 'ABCDEF')"
#: Days from 1900-01-01 to 2099-12-31: 17 times 4297.
DAYS = (17, 4297)


def quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def rounds(reverse: bool) -> str:
    return f"sequence({ROUNDS - 1}, 0)" if reverse else f"sequence(0, {ROUNDS - 1})"


def numbers(left: str, right: str, a: int, b: int, key: str, kind: str, reverse: bool) -> str:
    """SQL of ``struct(x, y)``: a permutation of pairs with ``x < a`` and ``y < b``."""

    def f(half: str) -> str:
        return f"cast(conv(substr(sha2(concat_ws('|', {quoted(key)}, '{kind}', i, {half}), 256), 1, 15), 16, 10) as bigint)"

    bound = f"if(i % 2 = 0, {a}L, {b}L)"
    step = (
        f"named_struct('x', pmod(s.y - {f('s.x')}, {bound}), 'y', s.x)" if reverse
        else f"named_struct('x', s.y, 'y', pmod(s.x + {f('s.y')}, {bound}))"
    )
    return f"aggregate({rounds(reverse)}, named_struct('x', cast({left} as bigint), 'y', cast({right} as bigint)), (s, i) -> {step})"


def symbols(value: str, kinds: str, key: str, kind: str, reverse: bool) -> str:
    """SQL of a permutation of strings whose positions keep their alphabets (``-``: fixed)."""
    sign = "-" if reverse else "+"

    def shifted(half: str, its: str, other: str) -> str:
        # By arrays, so that a long value takes time in proportion to its length.
        letters = f"element_at({ALPHABETS}, p.t)"
        move = "cast(conv(substr(k, 2 * pmod(j, 64) + 1, 2), 16, 10) as int)"
        new = f"substr({letters}, pmod(instr({letters}, p.c) - 1 {sign} {move}, length({letters})) + 1, 1)"
        both = f"zip_with(split({half}, ''), split({its}, ''), (c, t) -> named_struct('c', c, 't', t))"
        chars = f"transform({both}, (p, j) -> if(p.t = '-', p.c, {new}))"
        stream = f"array(sha2(concat_ws('|', {quoted(key)}, '{kind}', i, {other}), 512))"
        return f"if(length({half}) = 0, '', element_at(transform({stream}, k -> array_join({chars}, '')), 1))"

    step = (
        f"named_struct('x', {shifted('s.y', 's.b', 's.x')}, 'y', s.x, 'a', s.b, 'b', s.a)" if reverse
        else f"named_struct('x', s.y, 'y', {shifted('s.x', 's.a', 's.y')}, 'a', s.b, 'b', s.a)"
    )
    h = f"cast(length({value}) / 2 as int)"
    start = ", ".join(
        f"'{n}', {x}" for n, x in (("x", f"substr({value}, 1, {h})"), ("y", f"substr({value}, {h} + 1)"),
                                   ("a", f"substr({kinds}, 1, {h})"), ("b", f"substr({kinds}, {h} + 1)"))
    )
    return f"element_at(transform(array(aggregate({rounds(reverse)}, named_struct({start}), (s, i) -> {step})), r -> concat(r.x, r.y)), 1)"


def let(name: str, value: str, body: str) -> str:
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def refilled(template: str, digits: str, pattern: str = "[0-9]") -> str:
    """The characters of ``template`` that match ``pattern`` replaced by those of ``digits`` in order."""
    nth = f"length(regexp_replace(substr({template}, 1, p), '{pattern.replace('[', '[^')}', ''))"
    one = f"if(substr({template}, p, 1) rlike '{pattern}', substr({digits}, {nth}, 1), substr({template}, p, 1))"
    return f"array_join(transform(sequence(1, length({template})), p -> {one}), '')"


def luhn_digit(payload: str) -> str:
    double = f"pmod(length({payload}) - q, 2) = 0"
    digit = f"cast(substr({payload}, q, 1) as int)"
    total = f"aggregate(sequence(1, length({payload})), 0, (t, q) -> t + if({double}, {digit} * 2 - if({digit} > 4, 9, 0), {digit}))"
    return f"cast(pmod(10 - pmod({total}, 10), 10) as string)"


def remainder_97(text: str) -> str:
    char = f"substr({text}, q, 1)"
    value = f"if({char} rlike '[0-9]', t * 10 + ascii({char}) - 48, t * 100 + ascii({char}) - 55)"
    return f"aggregate(sequence(1, length({text})), 0, (t, q) -> pmod({value}, 97))"


def pseudonym(key: str, reverse: bool) -> str:
    """SQL over a found value ``m``."""
    digits = "regexp_replace(m, '[^0-9]', '')"

    def marks(value: str) -> str:
        return f"regexp_replace(regexp_replace(regexp_replace(regexp_replace({value}, '[^A-Za-z0-9]', '-'), '[a-z]', 'l'), '[A-Z]', 'u'), '[0-9]', 'd')"

    def sym(value: str, of: str, kind: str) -> str:
        return symbols(value, of, key, kind, reverse)

    email = let("v", "substring_index(m, '@', 1)", f"concat({sym('v', marks('v'), 'email')}, substr(m, length(v) + 1))")
    bare = "replace(m, ' ', '')"
    bban = let("v", f"substr({bare}, 5)", let("w", sym("v", marks("v"), "account"), let(
        "z", f"concat(substr(m, 1, 2), lpad(cast(98 - {remainder_97("concat(w, substr(m, 1, 2), '00')")} as string), 2, '0'), w)",
        refilled("m", "z", "[A-Z0-9]"))))
    account = f"if({remainder_97('concat(substr(' + bare + ', 5), substr(m, 1, 4))')} = 1, {bban}, m)"
    # Long hexadecimal values stay so, and are linked whether or not a name stands before them.
    # Of others, letters and digits are permuted in place and signs stay.
    def own(v: str) -> str:
        upper = f"regexp_replace(regexp_replace({v}, '[0-9]', 'd'), '[A-F]', 'h')"
        lower, capital = quoted("^[0-9a-f]{16,}$"), quoted("^[0-9A-F]{16,}$")
        return f"case when {v} rlike {lower} then repeat('x', length({v})) when {v} rlike {capital} then {upper} else {marks(v)} end"

    header = quoted(f"^(?:{NAMES}) ?[=:] ?[\"']?")
    hidden = let("h", f"regexp_extract(m, {header}, 0)", let("v", "substr(m, length(h) + 1)", f"concat(h, {sym('v', own('v'), 'secret')})"))
    access = f"concat(substr(m, 1, 4), {let('v', 'substr(m, 5)', sym('v', marks('v'), 'access'))})"
    secret = sym("m", own("m"), "secret")
    private = let("h", "regexp_extract(m, '^-----BEGIN [A-Z ]*PRIVATE KEY-----', 0)", let("v", "substr(m, length(h) + 1)", f"concat(h, {sym('v', marks('v'), 'private')})"))
    first, second, year = (f"cast(substr(m, {i}, {n}) as int)" for i, n in ((1, 2), (4, 2), (7, 4)))
    month_first = f"m like '__/%' and {second} > 12"
    notation = "case when m like '____-%' then 'yyyy-MM-dd' when m like '__.%' then 'dd.MM.yyyy' else 'dd/MM/yyyy' end"
    days = let("v", f"named_struct('n', datediff(try_to_date(m, {notation}), date'1900-01-01'), 'f', {notation})", let(
        "w", numbers(f"cast(v.n / {DAYS[1]} as int)", f"v.n % {DAYS[1]}", *DAYS, key, "date", reverse),
        f"if(v.n between 0 and {DAYS[0] * DAYS[1] - 1}, date_format(date_add(date'1900-01-01', cast(w.x * {DAYS[1]} + w.y as int)), v.f), m)"))
    # Dates that can only be read month first stay such dates: up to the 28th all of them are
    # permuted, later days keep day and month, and 29 February goes to a leap year.
    early = let("w", numbers(f"{year} - 1900", f"({first} - 1) * 16 + {second} - 13", 200, 192, key, "early", reverse),
                "format_string('%02d/%02d/%04d', w.y div 16 + 1, w.y % 16 + 13, w.x + 1900)")
    late = let("w", numbers(f"({year} - 1900) div 25", f"({year} - 1900) % 25", 8, 25, key, "late", reverse),
               "concat(substr(m, 1, 6), w.x * 25 + w.y + 1900)")
    leap = let("w", numbers(f"({year} - 1904) div 28", f"({year} - 1904) % 28 div 4", 7, 7, key, "leap", reverse),
               "concat(substr(m, 1, 6), (w.x * 7 + w.y) * 4 + 1904)")
    month = (
        f"case when try_to_date(m, 'MM/dd/yyyy') is null or {year} not between 1900 and 2099 then m "
        f"when {second} <= 28 then {early} when {first} = 2 then {leap} else {late} end"
    )
    days = f"if({month_first}, {month}, {days})"
    part = lambda i: f"cast(element_at(v, {i}) as int)"
    dotted = let("v", "split(m, '[.]')", let(
        "w", numbers(f"{part(1)} * 256 + {part(2)}", f"{part(3)} * 256 + {part(4)}", 65536, 65536, key, "address", reverse),
        "if(exists(v, o -> cast(o as int) > 255), m, concat_ws('.', w.x div 256, w.x % 256, w.y div 256, w.y % 256))"))
    area, group, serial = (f"cast(substr(m, {a}, {n}) as int)" for a, n in ((1, 3), (5, 2), (8, 4)))
    index = f"{area} - 1 - if({area} > 666, 1, 0)"
    social = let("w", numbers(index, f"({group} - 1) * 9999 + {serial} - 1", 898, 99 * 9999, key, "social", reverse), (
        f"if({area} between 1 and 899 and {area} <> 666 and {group} > 0 and {serial} > 0, "
        "format_string('%03d-%02d-%04d', w.x + 1 + if(w.x >= 665, 1, 0), w.y div 9999 + 1, w.y % 9999 + 1), m)"))
    card = let("v", digits, let(
        "w", sym("substr(v, 2, length(v) - 2)", "repeat('d', length(v) - 2)", "card"),
        let("z", "concat(substr(v, 1, 1), w)", f"if(luhn_check(v), {refilled('m', 'concat(z, ' + luhn_digit('z') + ')')}, m)")))
    phone = let("h", r"regexp_extract(m, '^([+][0-9]{1,3}(?=[ .(-])|[+][0-9])?', 0)", let(
        "v", "substr(m, length(h) + 1)", let("w", "regexp_replace(v, '[^0-9]', '')", let(
            "z", sym("w", "repeat('d', length(w))", "phone"), f"concat(h, {refilled('v', 'z')})"))))
    cases = {"email": email, "account": account, "private": private, "password": hidden, "access": access, "secret": secret, "date": days, "address": dotted,
             "social": social, "card": card, "phone": phone}
    whens = " ".join(f"when m rlike {quoted('^(?:' + PATTERNS[k] + ')$')} then {v}" for k, v in cases.items())
    return f"case {whens} else m end"


def run_key(spark) -> str:
    """The secret named by ``spark.obs_engine.pii.key``; without one, a run draws its own and keeps it to itself."""
    return spark.conf.get("spark.obs_engine.pii.key", None) or secrets.token_hex(32)


def pseudonymise(docs: DataFrame, key: str, reverse: bool = False) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced; ``n_replaced`` says how many values.

    A column of that name in ``docs`` passes unchanged; the count's then has underscores behind it.
    ``key`` is the secret of the permutation: it appears in the query plan, so plans and
    event logs must be kept like the key. With ``reverse`` pseudonyms are undone.
    """
    search = quoted(ANY)
    found, new, between, count = fresh(docs, "found", "new", "between", "n_replaced")
    likely = F.col("text").rlike("[0-9@=:]|A[KS]IA|gh[a-z]_|sk-|-----BEGIN")
    has = F.coalesce(F.size(found) > 0, F.lit(False))
    pairs = f"zip_with(slice({between}, 1, size({new})), {new}, (b, n) -> concat(b, n))"
    text = F.expr(f"concat(array_join({pairs}, ''), element_at({between}, -1))")
    changed = F.expr(f"size(filter(zip_with({found}, {new}, (f, n) -> f <> n), c -> c))")
    return (
        docs.withColumn(found, F.when(likely, F.expr(f"regexp_extract_all(text, {search}, 0)")))
        .withColumn(new, F.when(has, F.expr(f"transform({found}, m -> {pseudonym(key, reverse)})")))
        .withColumn(between, F.when(has, F.expr(f"split(text, {search}, -1)")))
        .withColumn("text", F.when(has, text).otherwise(F.col("text")))
        .withColumn(count, F.when(has, changed).otherwise(F.lit(0)))
        .drop(found, new, between)
    )
