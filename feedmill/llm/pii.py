"""Format-preserving pseudonyms for personal values.

Numbers and dates that pass their validity test are permuted inside the set of
valid values of the same format by a keyed Feistel network, so equal values get
equal pseudonyms in every document, different ones different pseudonyms, and a
pseudonym passes the same test. The network works on pairs ``(x, y)`` below
``(a, b)``: rounds add a keyed hash of one half to the other, modulo its size.

========  ==============================================  =======================
kind      valid                                           permuted
========  ==============================================  =======================
card      13 to 19 digits, Luhn sum right                 all digits, check digit new
iban      15 to 34 characters, remainder 1 modulo 97      all digits, check digits new
phone     +1 or (ddd) and ten digits                      the ten digits
plain     ddd-ddd-dddd, area and exchange from 2 on       area, exchange, line
world     + and 8 to 15 digits                            all but the first two
ssn       area 001-899 without 666, group, serial not 0   all
ipv4      octets to 255, first 1 to 223                   all
iso, dot  calendar date from 1900 on, 73 000 days         the day
slash     the same as dd/mm/yyyy, else as mm/dd/yyyy      the day
========  ==============================================  =======================

Mail addresses and secrets have no numeric format; they become keyed digests of
the same look. Everything is column expressions; the key is a parameter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmill.functions.text import bind
from feedmill.llm.common import unwrap, wrap

ROUNDS = 10
DAYS = (200, 365)
EPOCH = "1900-01-01"

#: One alternative per family; the kind of a match is told from its own form.
MAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
CLOUD_KEY = r"(?<![A-Za-z0-9])AKIA[A-Z0-9]{16}(?![A-Za-z0-9])"
SECRET = r"(?<![A-Za-z0-9])(?i:password|passwd|token|secret|api_key) ?[=:] ?\"?[A-Za-z0-9_-]{8,}"
PHONE = r"(?<![\w+(])(?:\+1[ .-]?)?\(\d{3}\) ?\d{3}[ .-]?\d{4}(?!\d)|(?<![\w+])\+1[ .-]?\d{3}[ .-]?\d{3}[ .-]?\d{4}(?!\d)|(?<![\w.+-])[2-9]\d\d[ .-][2-9]\d\d[ .-]\d{4}(?![\w-])"
WORLD = r"(?<![\w+])\+[1-9]\d(?:[ .-]?\d){6,13}(?!\d)"
DATE = r"(?<![\w.-])(?:\d{4}-\d\d-\d\d|\d\d\.\d\d\.\d{4}|\d\d/\d\d/\d{4})(?![\w-])"
IPV4 = r"(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?![\w]|\.\d)"
SSN = r"(?<![\w-])\d{3}-\d\d-\d{4}(?![\w-])"
CARD = r"(?<![\w-])\d(?:[ -]?\d){12,18}(?![\w-])"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}\d\d(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
ANY = "|".join([MAIL, CLOUD_KEY, SECRET, IBAN, PHONE, WORLD, DATE, IPV4, SSN, CARD])
#: 14 digits or more in two groups or more; no group runs on into a word or ends in a hyphen.
RUN = r"(?<![\w-])(?=(?:\d[ -]?){14})\d++(?!\w|-(?!\d))(?:[ -]\d++(?!\w|-(?!\d)))++"
BEFORE_RUN = "|".join([MAIL, CLOUD_KEY, SECRET, IBAN, PHONE, WORLD, DATE, IPV4, SSN, RUN])
#: A noncharacter, to mark cards with.
FENCE = "\ufdd0"


def _digest(key: str, *parts: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), *[p.cast("string") for p in parts]), 256)


def feistel(x: Column, y: Column, a: Column, b: Column, key: str, kind: Column) -> Column:
    """The image ``(x, y)`` of a pair of longs with 0 <= x < a, 0 <= y < b; one-to-one for each kind and size."""

    def step(s: Column, r: Column) -> Column:
        def add(to: Column, other: Column, size: Column) -> Column:
            noise = F.conv(F.substring(_digest(key, kind, a, b, r, other), 1, 15), 16, 10).cast("long")
            return F.pmod(to + F.pmod(noise, size), size)

        left = F.struct(add(s["x"], s["y"], a).alias("x"), s["y"].alias("y"))
        right = F.struct(s["x"].alias("x"), add(s["y"], s["x"], b).alias("y"))
        return F.when(r % 2 == 1, left).otherwise(right)

    start = F.struct(x.cast("long").alias("x"), y.cast("long").alias("y"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step)


def _number(digits: Column, start: int | Column, length: int | Column) -> Column:
    at, size = (v if isinstance(v, Column) else F.lit(v) for v in (start, length))
    return F.substr(digits, at, size).cast("long")


def _power(n: Column) -> Column:
    return F.rpad(F.lit("1"), n + 1, F.lit("0")).cast("long")


def _pad(value: Column, size) -> Column:
    return F.lpad(value.cast("string"), size, F.lit("0"))


def luhn(payload: Column) -> Column:
    """The check digit of a string of digits."""
    n = F.length(payload)

    def add(total: Column, i: Column) -> Column:
        d = F.substr(payload, n - i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return total + F.when(d > 9, d - 9).otherwise(d)

    total = F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add)
    return F.pmod(F.lit(10) - total % 10, F.lit(10))


def remainder(code: Column) -> Column:
    """A string of digits and capital letters modulo 97, letters counting from 10 on."""

    def add(total: Column, c: Column) -> Column:
        letter = F.rlike(c, F.lit("^[A-Z]$"))
        return F.when(letter, (total * 100 + F.ascii(c) - 55) % 97).otherwise((total * 10 + c.cast("long")) % 97)

    return F.aggregate(F.filter(F.split(code, ""), lambda c: c != ""), F.lit(0).cast("long"), add)


def _refill(shape: Column, digits: Column, taken: str = "^[0-9]$") -> Column:
    """``shape`` with its digits (or what ``taken`` matches) replaced in turn by ``digits``."""

    def put(s: Column, c: Column) -> Column:
        digit = F.rlike(c, F.lit(taken))
        new = F.when(digit, F.substr(digits, s["i"] + 1, F.lit(1))).otherwise(c)
        return F.struct(F.concat(s["t"], new).alias("t"), (s["i"] + F.when(digit, 1).otherwise(0)).alias("i"))

    zero = F.struct(F.lit("").alias("t"), F.lit(0).alias("i"))
    return F.aggregate(F.split(shape, ""), zero, put)["t"]


def _day(m: Column, form: str) -> Column:
    """Days since EPOCH of a valid date in range, else null."""
    days = F.datediff(F.to_date(F.try_to_timestamp(m, F.lit(form))), F.lit(EPOCH))
    # Lenient readings such as 31 February do not read back as written.
    return F.when((days >= 0) & (days < DAYS[0] * DAYS[1]) & (F.date_format(F.date_add(F.lit(EPOCH).cast("date"), days), form) == m), days)


#: Date kinds and how they are written.
DATES = {"iso": "yyyy-MM-dd", "dot": "dd.MM.yyyy", "dmy": "dd/MM/yyyy", "mdy": "MM/dd/yyyy"}


def _kind(m: Column, d: Column) -> Column:
    """The kind of a match, null if it is not valid; ``d`` are its digits."""
    octets = F.split(m, r"\.")
    in_range = F.forall(octets, lambda o: o.cast("int") < 256) & F.get(octets, F.lit(0)).cast("int").between(1, 223)
    area, group, serial = _number(d, 1, 3), _number(d, 4, 2), _number(d, 6, 4)
    social = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    full = lambda p: F.rlike(m, F.lit(f"^(?:{p})$"))
    kind = F.when(F.contains(m, F.lit("@")), "mail").when(full(r"AKIA[A-Z0-9]{16}"), "cloud").when(F.rlike(m, F.lit(r"^(?i:[a-z_]+) ?[=:]")), "secret")
    code = F.replace(m, F.lit(" "), F.lit(""))
    moved = F.concat(F.substr(code, F.lit(5), F.length(code)), F.substr(code, F.lit(1), F.lit(4)))
    account = full(r"[A-Z]{2}\d\d[A-Z0-9 ]+") & F.length(code).between(15, 34)
    kind = kind.when(F.when(account, remainder(moved) == 1).otherwise(False), "iban")
    kind = kind.when(full(r"[2-9]\d\d[ .-][2-9]\d\d[ .-]\d{4}"), "plain")
    kind = kind.when(full(r"(?:\+1[ .-]?)?\(?\d{3}\)?[ .-]?\d{3}[ .-]?\d{4}"), "phone")
    kind = kind.when(F.startswith(m, F.lit("+")), "world")
    shapes = {"iso": r"\d{4}-\d\d-\d\d", "dot": r"\d\d\.\d\d\.\d{4}", "dmy": r"\d\d/\d\d/\d{4}", "mdy": r"\d\d/\d\d/\d{4}"}
    for name, form in DATES.items():
        kind = kind.when(F.when(full(shapes[name]), _day(m, form).isNotNull()).otherwise(False), name)
    kind = kind.when(F.when(full(r"(?:\d{1,3}\.){3}\d{1,3}"), in_range).otherwise(False), "ipv4")
    kind = kind.when(F.when(full(r"\d{3}-\d\d-\d{4}"), social).otherwise(False), "ssn")
    card = F.length(d).between(13, 19) & full(r"[\d -]+")
    payload = F.substr(d, F.lit(1), F.length(d) - 1)
    return kind.when(F.when(card, luhn(payload) == F.substr(d, F.length(d), F.lit(1)).cast("int")).otherwise(False), "card")


def _pair(m: Column, d: Column, kind: Column) -> Column:
    """``(x, y, a, b)`` of a valid number or date."""
    quad = lambda x, y, a, b: F.struct(
        *[(v if isinstance(v, Column) else F.lit(v)).cast("long").alias(n) for v, n in zip((x, y, a, b), "xyab")]
    )
    n = F.length(d)
    half = F.floor((n - 1) / 2).cast("int")
    card = quad(_number(d, 1, half), _number(d, half + 1, n - 1 - half), _power(half), _power(n - 1 - half))
    tail = F.substr(d, n - 9, F.lit(10))
    phone = quad(_number(tail, 1, 3), _number(tail, 4, 7), 1000, 10**7)
    plain = quad(
        _number(tail, 1, 3) - 200, (_number(tail, 4, 3) - 200) * 10000 + _number(tail, 7, 4), 800, 800 * 10000
    )
    inner = F.substr(d, F.lit(3), n)  # without the check digits
    part = F.floor((n - 2) / 2).cast("int")
    iban = quad(_number(inner, 1, part), F.substr(inner, part + 1, n).cast("long"), _power(part), _power(n - 2 - part))
    rest = F.substr(d, F.lit(3), n)
    some = F.floor((n - 2) / 2).cast("int")
    world = quad(_number(rest, 1, some), F.substr(rest, some + 1, n).cast("long"), _power(some), _power(n - 2 - some))
    area = _number(d, 1, 3)
    ssn = quad(
        area - 1 - F.when(area > 666, 1).otherwise(0), (_number(d, 4, 2) - 1) * 9999 + _number(d, 6, 4) - 1, 898, 99 * 9999
    )
    o = F.transform(F.split(m, r"\."), lambda v: v.cast("long"))
    at = lambda i: F.get(o, F.lit(i))
    ipv4 = quad((at(0) - 1) * 256 + at(1), at(2) * 256 + at(3), 223 * 256, 65536)
    out = F.when(kind == "card", card).when(kind == "iban", iban).when(kind == "phone", phone).when(kind == "world", world)
    out = out.when(kind == "plain", plain).when(kind == "ssn", ssn).when(kind == "ipv4", ipv4)
    for name, form in DATES.items():
        day = _day(m, form)
        out = out.when(kind == name, quad(F.floor(day / DAYS[1]), day % DAYS[1], *DAYS))
    return out


def _written(m: Column, d: Column, kind: Column, p: Column, q: Column) -> Column:
    """The pair ``p`` in the form of ``m``; ``q`` holds the sizes."""
    n = F.length(d)
    half = F.floor((n - 1) / 2).cast("int")
    payload = F.concat(_pad(p["x"], half), _pad(p["y"], n - 1 - half))
    card = bind(payload, lambda v: _refill(m, F.concat(v, luhn(v).cast("string"))))
    number = F.concat((p["x"] + 200).cast("string"), (F.floor(p["y"] / 10000) + 200).cast("string"), _pad(p["y"] % 10000, 4))
    plain = _refill(m, number)
    phone = _refill(m, F.concat(F.substr(d, F.lit(1), n - 10), _pad(p["x"], 3), _pad(p["y"], 7)))
    some = F.floor((n - 2) / 2).cast("int")
    world = _refill(m, F.concat(F.substr(d, F.lit(1), F.lit(2)), _pad(p["x"], some), _pad(p["y"], n - 2 - some)))
    area = p["x"] + 1 + F.when(p["x"] + 1 >= 666, 1).otherwise(0)
    ssn = F.concat_ws("-", _pad(area, 3), _pad(F.floor(p["y"] / 9999) + 1, 2), _pad(p["y"] % 9999 + 1, 4))
    octets = [F.floor(p["x"] / 256) + 1, p["x"] % 256, F.floor(p["y"] / 256), p["y"] % 256]
    ipv4 = F.concat_ws(".", *[o.cast("string") for o in octets])
    code = F.replace(m, F.lit(" "), F.lit(""))
    land = F.substr(code, F.lit(1), F.lit(2))
    part = F.floor((n - 2) / 2).cast("int")
    number = _refill(F.substr(code, F.lit(5), F.length(code)), F.concat(_pad(p["x"], part), _pad(p["y"], n - 2 - part)))
    iban = bind(
        number,
        lambda v: _refill(
            m, F.concat(land, _pad(98 - remainder(F.concat(v, land, F.lit("00"))), 2), v), "^[A-Z0-9]$"
        ),
    )
    out = F.when(kind == "card", card).when(kind == "iban", iban).when(kind == "phone", phone).when(kind == "world", world)
    out = out.when(kind == "plain", plain).when(kind == "ssn", ssn).when(kind == "ipv4", ipv4)
    for name, form in DATES.items():
        day = F.date_add(F.lit(EPOCH).cast("date"), (p["x"] * DAYS[1] + p["y"]).cast("int"))
        out = out.when(kind == name, F.date_format(day, form))
    return out


def _text_value(m: Column, kind: Column, key: str) -> Column:
    """Keyed digests in the look of a mail address, cloud key or secret."""
    code = _digest(key, kind, F.when(kind == "mail", F.lower(m)).otherwise(m))
    head = F.regexp_extract(m, r"^(?i:[a-z_]+) ?[=:] ?\"?", 0)
    body = F.length(m) - F.length(head)
    long_code = F.concat(code, F.sha2(code, 256))
    secret = F.concat(head, F.substr(F.repeat(long_code, F.ceil(body / 128).cast("int")), F.lit(1), body))
    return (
        F.when(kind == "mail", F.concat(F.lit("u"), F.substring(code, 1, 20), F.lit("@example.invalid")))
        .when(kind == "cloud", F.concat(F.lit("AKIA"), F.upper(F.substring(code, 1, 16))))
        .when(kind == "secret", secret)
    )


def pseudonym(match: Column, key: str) -> Column:
    """The pseudonym of one match of ``ANY``; null if it is not a valid value."""

    def with_kind(v: Column) -> Column:
        m, d, kind = v["m"], v["d"], v["k"]
        number = bind(
            _pair(m, d, kind),
            lambda q: bind(feistel(q["x"], q["y"], q["a"], q["b"], key, kind), lambda p: _written(m, d, kind, p, q)),
        )
        return F.when(kind.isin("mail", "cloud", "secret"), _text_value(m, kind, key)).when(kind.isNotNull(), number)

    parts = bind(
        F.struct(match.alias("m"), F.regexp_replace(match, "[^0-9]", "").alias("d")),
        lambda v: F.struct(v["m"].alias("m"), v["d"].alias("d"), _kind(v["m"], v["d"]).alias("k")),
    )
    return bind(parts, with_kind)


def _card_at(groups: Column, i: Column) -> Column:
    """How many of a run's groups of digits from ``i`` on are one card by length, form and check digit; 0 for none."""

    def rated(k: Column) -> Column:
        digits = F.array_join(F.transform(F.slice(groups, i + 1, k), lambda g: F.regexp_replace(g, "[ -]", "")), "")

        def rate(d: Column) -> Column:
            n = F.length(d)
            # The commonest length first. One group of digits may begin with any of them.
            order = F.when(n == 16, 1).when(n == 15, 2).when(n == 14, 3).when(n == 13, 4).when(n.between(17, 19), 5)
            known = (k == 1) | F.when(n == 16, F.rlike(d, F.lit("^(?:[3-6]|2[2-7])"))).when(n.isin(14, 15), F.startswith(d, F.lit("3"))).when(
                n == 13, F.startswith(d, F.lit("4"))
            ).when(n == 19, F.rlike(d, F.lit("^[3-6]")))
            valid = F.when(
                order.isNotNull() & known, luhn(F.substr(d, F.lit(1), n - 1)) == F.substr(d, n, F.lit(1)).cast("int")
            )
            return F.when(F.coalesce(valid, F.lit(False)), F.struct(order.alias("order"), k.alias("k")))

        return bind(digits, rate)

    # No card is written in more than five groups.
    most = F.least(F.lit(5), F.size(groups) - i)
    return F.coalesce(F.array_min(F.transform(F.sequence(F.lit(1), most), rated))["k"], F.lit(0))


def _fence_run(run: Column, fence: Column) -> Column:
    """A run of digits with ``fence`` before and after each card in it that begins and ends at a separator."""

    def mark(groups: Column) -> Column:
        def step(s: Column, i: Column) -> Column:
            group = F.get(groups, i)
            digits = F.regexp_replace(group, "[ -]", "")
            separator = F.substr(group, F.length(digits) + 1, F.length(group))

            def put(left: Column) -> Column:
                # Left counts the groups of the card that are still to come, this one included.
                opens = F.when((s["left"] == 0) & (left > 0), fence).otherwise("")
                closes = F.when(left == 1, fence).otherwise("")
                return F.struct(
                    F.concat(s["t"], opens, digits, closes, separator).alias("t"), F.greatest(left - 1, F.lit(0)).alias("left")
                )

            return bind(F.when(s["left"] > 0, s["left"]).otherwise(_card_at(groups, i)), put)

        zero = F.struct(F.lit("").alias("t"), F.lit(0).alias("left"))
        return F.aggregate(F.sequence(F.lit(0), F.size(groups) - 1), zero, step)["t"]

    return bind(F.split(run, "(?<=[ -])"), mark)


def fenced(text: Column, fence: Column) -> Column:
    """``text`` with ``fence`` around each card that stands beside other groups of digits.

    The longest run of digits over blanks and hyphens may hold a card and a
    short number; no pattern tells where it must be cut, only the check digit.
    What the other patterns match first is no part of a run.
    """
    found = F.regexp_extract_all(text, F.lit(BEFORE_RUN), F.lit(0))

    def mark(m: Column) -> Column:
        run = F.rlike(m, F.lit("^[0-9 -]+$")) & (F.length(F.regexp_replace(m, "[^0-9]", "")) > 13)
        return F.when(run, _fence_run(m, fence)).otherwise(m)

    marked = bind(
        F.transform(found, mark),
        lambda runs: F.array_join(
            F.transform(F.split(text, BEFORE_RUN, -1), lambda part, i: F.concat(part, F.coalesce(F.get(runs, i), F.lit("")))), ""
        ),
    )
    return F.when(F.rlike(text, F.lit(RUN)), marked).otherwise(text)


def pseudonymize(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` with pseudonyms in ``text``, plus ``_values``: what was replaced, in order.

    Null texts stay null; texts without a valid value stay as they are. Texts
    without a digit or ``@`` are passed over by one cheap test.
    """
    body = F.col("_text")
    # One more of a character than the text has of it, so that what marks a card is told from the text.
    had = F.length(body) - F.length(F.replace(body, F.lit(FENCE), F.lit("")))
    some = F.rlike(body, F.lit("[0-9@]")) | F.rlike(body, F.lit("(?i:password|passwd|token|secret|api_key)"))
    found = F.when(some, F.regexp_extract_all("_cut", F.lit(ANY), F.lit(0)))
    step = wrap(docs, _text=F.col(text)).withColumn("_fence", F.repeat(F.lit(FENCE), had + 1))
    step = step.withColumn("_cut", fenced(body, F.col("_fence"))).withColumn("_m", found)
    step = step.withColumn("_n", F.transform("_m", lambda m: F.struct(m.alias("m"), pseudonym(m, key).alias("p"))))
    joined = F.array_join(
        F.transform(
            F.split("_cut", ANY, -1),
            lambda part, i: F.concat(part, F.coalesce(F.get("_n", i)["p"], F.get("_n", i)["m"], F.lit(""))),
        ),
        "",
    )
    joined = F.replace(joined, F.col("_fence"), F.lit(""))
    hit = F.coalesce(F.exists("_n", lambda x: x["p"].isNotNull()), F.lit(False))
    values = F.transform(F.filter("_n", lambda x: x["p"].isNotNull()), lambda x: x["m"])
    values = F.coalesce(values, F.array().cast("array<string>")).alias("_values")
    return unwrap(step, docs.columns, values, **{text: F.when(hit, joined).otherwise(body)})
