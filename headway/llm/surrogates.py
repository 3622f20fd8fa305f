"""Personal data replaced by keyed surrogates of the same kind, with DataFrame functions only.

One pattern finds e-mail addresses, phone, card and social-security numbers, IBANs, IP
addresses of both kinds and names behind a title. An entity is the kind and normal form of
what was found: an address in lower case, the digits of a number, a given name with its
gender, initials, or a surname. Its surrogate is a function of a secret key, the kind and
the normal form, so mentions of one entity agree in every document, however they are
written. Surrogates keep the format: digits, letters, case, separators, country codes,
check digits, script and gender; initials become other initials.

Numbers and addresses go through a keyed permutation of all values of their form: Feistel
rounds, a shift that moves every value, and the rounds back. So different entities get
different surrogates and none keeps its own, by construction and however crowded a form
is. A surrogate may be equal to another entity of the table where the form has few values.

Names are drawn: given names from lists by gender and script, surnames as syllables of the
script. Collision check: names whose surrogates are equal to another's are drawn again,
as one word of syllables that grows by a syllable a round, until all differ. The first is
worked out inside each row; only documents that mention one of the others are joined with
their attempts.

Defined results: a null text stays null and has no mentions; a text without mentions stays
as it is; repeated rows get equal results; an empty table gives no rows. A local part with
letters outside the alphabets below, or ending in "%", becomes Latin letters and a "%", four
letters or more for each of its own outside ASCII. Values without a letter or digit to
change, and groups of zeros in IPv6 addresses, stay.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm import common

#: Key of the surrogates; a deployment gives its own.
KEY = "headway"

#: Names that a task draws surrogates for.
NAMES_A_TASK = 20_000

#: Titles by gender, and names to choose from by gender and script.
TITLES = {
    "m": ["Mr", "Herr", "Señor", "Monsieur", "Господин"],
    "f": ["Mrs", "Ms", "Miss", "Frau", "Señora", "Madame", "Mme", "Госпожа"],
    "x": ["Dr", "Prof"],
}
GIVEN = {
    "m": ["Adrian", "Bruno", "Carl", "Daniel", "Emil", "Felix", "Georg", "Hugo", "Ivan", "Jonas", "Karl", "Leon"],
    "f": ["Alma", "Bianca", "Clara", "Diana", "Elena", "Frida", "Greta", "Helena", "Irina", "Julia", "Karla", "Lena"],
    "x": ["Alex", "Ariel", "Chris", "Dana", "Eden", "Jamie", "Kim", "Noel", "Robin", "Sasha", "Toni", "Vanja"],
}
GIVEN_CYRILLIC = {
    "m": ["Антон", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Игорь", "Кирилл"],
    "f": ["Анна", "Вера", "Галина", "Дарья", "Елена", "Жанна", "Инна", "Ксения"],
    "x": ["Саша", "Женя", "Валя", "Слава"],
}

#: Syllables of drawn names: sounds that open one, vowels, sounds that close one.
SYLLABLES = {
    "": ("b br ch d dr f fl g gl gr h j k kl kr l m n p pl pr r s sch sl st t tr v w z", "a e i o u", ",n,r,l,s"),
    "_cyrillic": ("б бр в г гл д др ж з к кл кр л м н п пр р с ст т тр ф х ч ш", "а е и о у", ",н,р,л,с"),
}
#: Endings of drawn names by kind.
ENDINGS = {
    "given_m": "on", "given_f": "ina", "given_x": "y", "surname": "",
    "given_m_cyrillic": "ан", "given_f_cyrillic": "ина", "given_x_cyrillic": "и",
    "surname_cyrillic": "ов", "surname_cyrillic_f": "ова",
}

#: Alphabets that initials are taken from.
ALPHABETS = ["ABCDEFGHIJKLMNOPQRSTUVWXYZ", "ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞŁŚŠŽ", "АБВГДЕЁЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯ"]

def _cased(low: int, high: int) -> str:
    """The small letters of a range that have a capital of one character which gives them back."""
    letters = (chr(c) for c in range(low, high))
    return "".join(c for c in letters if c.isalpha() and c != c.upper() and len(c.upper()) == 1 and c.upper().lower() == c)


#: Characters that permutations stay within: digits, capitals, and small letters by script.
CLASSES = ["0123456789", ALPHABETS[0], ALPHABETS[0].lower(), _cased(0xE0, 0x180), _cased(0x3B1, 0x3CA), _cased(0x430, 0x460)]
ALL = "".join(CLASSES)
#: Local parts of these characters keep their letters' classes.
PLAIN_LOCAL = f"^[{''.join(CLASSES[:1] + CLASSES[2:])}._%+-]*[{''.join(CLASSES[:1] + CLASSES[2:])}._+-]$"
#: Feistel rounds before the shift, and as many back behind it.
ROUNDS = 4

_LEFT, _RIGHT = r"(?<![\p{L}\p{N}])", r"(?![\p{L}\p{N}])"
_TITLE = "|".join(t for g in "mfx" for t in TITLES[g])
#: A word of a name may have capitals inside, as McDonald, O'Brien or SMITH, but no genitive.
_PART = r"\p{Lu}(?:[\p{L}\p{M}]|['’](?!S(?!\p{L}))(?=\p{Lu}))+"
_WORD = rf"{_PART}(?:-{_PART})*(?!\p{{L}})"
_INITIALS = rf"(?:[{''.join(ALPHABETS)}]\.)+"
_HEX = "[0-9A-Fa-f]{1,4}"
#: What each kind looks like, the more special first.
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,4}\.[A-Za-z]{2,24}",
    "iban": _LEFT + r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?" + _RIGHT,
    # slices as 1::2 are none
    "ip6": r"(?<![\p{L}\p{N}:.])(?=[0-9A-Fa-f]{3,4}:|(?:[0-9A-Fa-f]{0,4}:){3})(?=[A-Fa-f:]*[0-9])"
    rf"(?:(?:{_HEX}:){{7}}{_HEX}|(?:{_HEX}:){{1,6}}(?::{_HEX}){{1,6}}|(?:{_HEX}:){{2,7}}:|::(?:{_HEX}:){{1,6}}{_HEX})"
    r"(?![\p{L}\p{N}:]|\.[0-9])",
    "ip": r"(?<![\p{L}\p{N}.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?!\.?[0-9])",
    "phone": r"(?<![\p{L}\p{N}])\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?(?:[ .-]?[0-9]{2,4}){1,4}(?![0-9])"
    r"|(?<![\p{L}\p{N}])\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}(?![0-9])"
    r"|(?<![\p{L}\p{N}-])[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])",
    "ssn": r"(?<![\p{L}\p{N}-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "card": _LEFT + r"(?:(?:[0-9]{4}[ -]){3}[0-9]{4}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})" + _RIGHT + "|" + _LEFT + r"[0-9]{13,19}" + _RIGHT,
    "name": rf"(?<!\p{{L}})(?:{_TITLE})\.? (?:{_INITIALS} ?){{0,4}}{_WORD}(?: (?:{_INITIALS} ?){{0,4}}{_WORD})?",
}
PATTERN = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: Texts without any of these need no search.
HINT = rf"[0-9@]|(?:{_TITLE})\.? \p{{Lu}}"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _kind(found: Column) -> Column:
    out = None
    for kind, pattern in PATTERNS.items():
        fits = found.rlike(f"^(?:{pattern})$")
        out = F.when(fits, F.lit(kind)) if out is None else out.when(fits, F.lit(kind))
    return out.otherwise(F.lit("other"))


def _title(found: Column) -> Column:
    return F.regexp_extract(found, rf"^((?:{_TITLE})\.? )", 1)


def _gender(title: Column) -> Column:
    bare = F.regexp_replace(title, r"\.? $", "")
    return F.when(bare.isin(TITLES["m"]), "m").when(bare.isin(TITLES["f"]), "f").otherwise("x")


_NAME_PART = f"{_INITIALS}|{_WORD}"


def _name(found: Column) -> Column:
    """A name without its title."""
    return F.substring(found, F.length(_title(found)) + 1, F.lit(1 << 20))


def _name_parts(found: Column) -> Column:
    """Initials and words of a name."""
    return F.regexp_extract_all(_name(found), F.lit(_NAME_PART), F.lit(0))


def _groups(address: Column) -> tuple[Column, Column]:
    """The groups of an IPv6 address before and behind its double colon."""
    halves = F.split(address, "::")
    split = lambda half: F.filter(F.split(half, ":"), lambda g: g != "")
    return split(F.element_at(halves, 1)), split(F.when(F.size(halves) > 1, F.element_at(halves, -1)).otherwise(""))


def _full_address(address: Column) -> Column:
    """All groups of an IPv6 address, of four digits."""
    left, right = _groups(F.lower(address))
    zeros = F.array_repeat(F.lit("0"), F.lit(8) - F.size(left) - F.size(right))
    return F.array_join(F.transform(F.concat(left, zeros, right), lambda g: F.lpad(g, 4, "0")), ":")


def _octets(address: Column) -> Column:
    return F.transform(F.split(address, r"\."), lambda part: part.cast("int"))


def _entities(kind: Column, found: Column) -> Column:
    """The entities of a mention: kind, and normal form."""

    def entity(name: Column | str, value: Column) -> Column:
        return F.struct((F.lit(name) if isinstance(name, str) else name).alias("kind"), value.alias("value"))

    code = F.regexp_extract(found, r"^\+([0-9]{1,3})(?=[ (.-])", 1)
    parts = _name_parts(found)
    script = lambda w: F.when(w.rlike(r"\p{IsCyrillic}"), F.lit("_cyrillic")).otherwise(F.lit(""))
    last = F.element_at(parts, -1)
    ending = F.when(last.rlike(r"(?iu)\p{IsCyrillic}а$"), F.lit("_f")).otherwise(F.lit(""))
    surname = entity(F.concat(F.lit("surname"), script(last), ending), F.lower(last))
    gender = _gender(_title(found))
    given = F.transform(
        F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(0))),
        lambda w: F.when(w.rlike(f"^{_INITIALS}$"), entity("given_initial", w)).otherwise(
            entity(F.concat(F.lit("given_"), gender, script(w)), F.lower(w))
        ),
    )
    return (
        F.when(kind == "name", F.concat(given, F.array(surname)))
        .when(kind == "email", F.array(entity("email", F.lower(found))))
        .when(kind == "phone", F.array(entity("phone", F.concat(code, F.lit("|"), _digits(found)))))
        .when(kind == "iban", F.array(entity("iban", F.regexp_replace(found, " ", ""))))
        .when(kind == "ip", F.array(entity("ip", F.array_join(_octets(found).cast("array<string>"), "."))))
        .when(kind == "ip6", F.array(entity("ip6", _full_address(found))))
        .otherwise(F.array(entity(kind, _digits(found))))
    )


def mentions(text: Column) -> Column:
    """The mentions of a text in order: kind, original and entities."""
    found = F.when(text.rlike(HINT), F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))).otherwise(
        F.array().cast("array<string>")
    )
    kinds = F.transform(found, lambda m: F.struct(_kind(m).alias("kind"), m.alias("original")))
    return F.transform(
        kinds, lambda m: F.struct(m["kind"], m["original"], _entities(m["kind"], m["original"]).alias("entities"))
    )


def _random(seed: Column, i: Column) -> Column:
    """A number from 0 to 65535 for place ``i`` (from 1), out of 128 hexadecimal digits."""
    return F.conv(F.substring(seed, F.pmod(i - 1, F.lit(32)) * 4 + 1, F.lit(4)), 16, 10).cast("int")


def _each(value: Column, change) -> Column:
    """``change(character, place)`` of every character, put together."""
    places = F.sequence(F.lit(1), F.greatest(F.length(value), F.lit(1)))
    return F.array_join(F.transform(places, lambda i: change(F.substring(value, i, F.lit(1)), i)), "")


def _bound(value: Column, use) -> Column:
    """``use(value)``, with the value worked out once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _permuted(digits: Column, sizes: Column, key: str, tweak: Column) -> Column:
    """A keyed permutation without fixed points of lists of numbers, each from 0 to its size.

    Numbers at even places are moved by a hash of those at odd places and the other way
    round, ``ROUNDS`` times; then all are moved by other amounts than zero; then the rounds are
    undone. Numbers of size 1 stay. The tweak and the sizes choose the permutation.
    """
    steps = [(r, 1) for r in range(ROUNDS)] + [(ROUNDS, 0)] + [(r, -1) for r in reversed(range(ROUNDS))]
    listed = F.array(*(F.struct(F.lit(r).alias("round"), F.lit(sign).alias("sign")) for r, sign in steps))
    given = F.struct(
        digits.alias("digits"),
        sizes.alias("sizes"),
        F.concat_ws("\x1f", F.lit(key), tweak, F.array_join(sizes.cast("array<string>"), ",")).alias("base"),
    )

    def step(now: Column, each: Column, g: Column) -> Column:
        odd = F.pmod(each["round"], F.lit(2))
        others = F.filter(now, lambda _, i: F.pmod(i, F.lit(2)) != odd)
        told = F.when(each["sign"] == 0, F.lit("")).otherwise(F.array_join(others.cast("array<string>"), ","))
        seed = F.sha2(F.concat_ws("\x1f", g["base"], each["round"].cast("string"), told), 512)

        def moved(h: Column) -> Column:
            def one(d: Column, i: Column) -> Column:
                size = F.get(g["sizes"], i)
                by = _random(h, i + 1)
                shift = F.pmod(by, F.greatest(size - 1, F.lit(1))) + 1
                turn = F.when(F.pmod(i, F.lit(2)) == odd, by * each["sign"]).otherwise(F.lit(0))
                return F.pmod(d + F.when(each["sign"] == 0, shift).otherwise(turn), size)

            return F.transform(now, one)

        return _bound(seed, moved)

    return _bound(given, lambda g: F.aggregate(listed, g["digits"], lambda now, each: step(now, each, g)))


def _moved(value: Column, key: str, tweak: Column) -> Column:
    """Characters replaced by others of their class; those of no class stay."""
    starts, at = [], 1
    for letters in CLASSES:
        starts.append((at, len(letters)))
        at += len(letters)

    def by_class(place: Column, pick, none: int) -> Column:
        out = F.when(place == 0, F.lit(none))
        for start, size in starts:
            out = out.when(place < start + size, F.lit(pick(start, size)))
        return out

    first = lambda place: by_class(place, lambda start, _: start, 0)
    size = lambda place: by_class(place, lambda _, size: size, 1)

    def with_places(g: Column) -> Column:
        digits = F.transform(g["places"], lambda p: p - first(p))
        moved = _permuted(digits, F.transform(g["places"], size), key, tweak)

        def letter(d: Column, i: Column) -> Column:
            place = F.get(g["places"], i)
            return F.when(place == 0, F.get(g["chars"], i)).otherwise(F.substring(F.lit(ALL), first(place) + d, F.lit(1)))

        return F.array_join(F.transform(moved, letter), "")

    chars = F.regexp_extract_all(value, F.lit("(?s)."), F.lit(0))
    placed = _bound(
        chars,
        lambda c: F.struct(c.alias("chars"), F.transform(c, lambda x: F.position(x, F.lit(ALL))).alias("places")),
    )
    return _bound(placed, with_places)


def _luhn(digits: Column, checked: bool) -> Column:
    """The sum of a digit string by the card rule; ``checked`` if its last digit is the check digit."""
    places = F.sequence(F.lit(1), F.greatest(F.length(digits), F.lit(1)))
    twice = 0 if checked else 1

    def value(i: Column) -> Column:
        d = F.substring(digits, -i, F.lit(1)).cast("int")
        doubled = F.when(d * 2 > 9, d * 2 - 9).otherwise(d * 2)
        return F.when(F.pmod(i, F.lit(2)) == twice, doubled).otherwise(d)

    return F.aggregate(F.transform(places, value), F.lit(0), lambda a, b: a + F.coalesce(b, F.lit(0)))


def _chosen(names: list[str], seed: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, names)), F.pmod(_random(seed, F.lit(1)), F.lit(len(names))) + 1)


def _drawn(kind: Column, seed: Column, syllables: Column) -> Column:
    """A word of so many syllables with the ending of the kind."""

    def syllable(i: Column) -> Column:
        def spelt(n: Column) -> Column:
            scripts = []
            for sounds in SYLLABLES.values():
                rest, out = n, []
                for listed, mark in zip(sounds, "  ,"):
                    choices = listed.split(mark)
                    out.append(F.element_at(F.array(*map(F.lit, choices)), F.pmod(rest, F.lit(len(choices))) + 1))
                    rest = F.floor(rest / len(choices)).cast("int")
                scripts.append(F.concat(*out))
            return F.when(kind.contains("_cyrillic"), scripts[1]).otherwise(scripts[0])

        return _bound(_random(seed, i), spelt)

    word = F.array_join(F.transform(F.sequence(F.lit(1), syllables), syllable), "")
    endings = F.create_map(*(F.lit(x) for pair in ENDINGS.items() for x in pair))
    return F.initcap(F.concat(word, F.element_at(endings, kind)))


def _iban_rest(iban: Column) -> Column:
    """The remainder by 97 of an IBAN as a number; 1 if its check digits are right."""
    turned = F.concat(F.substring(iban, F.lit(5), F.lit(1 << 20)), F.substring(iban, 1, 4))
    values = F.transform(
        F.sequence(F.lit(1), F.greatest(F.length(turned), F.lit(1))),
        lambda i: F.position(F.substring(turned, i, F.lit(1)), F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ")) - 1,
    )
    return F.aggregate(values, F.lit(0), lambda a, v: F.pmod(a * F.when(v > 9, 100).otherwise(10) + v, F.lit(97)))


def _other_initials(key: str, value: Column) -> Column:
    """Every letter replaced by the next of its alphabet in an order that depends on the key."""
    mixed = [random.Random(f"{key}\x1f{a}").sample(a, len(a)) for a in ALPHABETS]
    return F.translate(value, "".join(c for m in mixed for c in m), "".join(c for m in mixed for c in m[1:] + m[:1]))


def _off(value: Column, right: Column, size: int) -> Column:
    """How far check digits are from the right ones."""
    return F.pmod(value.cast("int") - right, F.lit(size))


def _written_value(key: str, kind: Column, value: Column) -> Column:
    """The surrogate of an entity of digits and letters.

    What is moved is a local part, the digits behind a country code, a card without its check
    digit, the account of an IBAN, or all; check digits stay as far from the right ones as
    they were.
    """
    local, domain = F.substring_index(value, "@", 1), F.substring_index(value, "@", -1)
    ending = F.regexp_extract(domain, r"(\.[a-z]+)$", 1)
    host = F.substring(domain, F.lit(1), F.length(domain) - F.length(ending))
    plain = local.rlike(PLAIN_LOCAL)
    spelt = F.translate(F.hex(F.encode(local, "UTF-8")), "0123456789ABCDEF", "abcdefghijklmnop")
    code, number = F.substring_index(value, "|", 1), F.substring_index(value, "|", -1)
    country = F.substring(value, 1, 2)
    inside = F.struct(
        F.when(kind == "email", F.when(plain, local).otherwise(spelt))
        .when(kind == "phone", F.substring(number, F.length(code) + 1, F.lit(1 << 20)))
        .when(kind == "card", F.substring(value, F.lit(1), F.length(value) - 1))
        .when(kind == "iban", F.substring(value, F.lit(5), F.lit(1 << 20)))
        .otherwise(value)
        .alias("text"),
        F.concat_ws(
            "\x1f",
            kind,
            F.when(kind == "email", F.concat_ws("\x1f", domain, plain.cast("string")))
            .when(kind == "phone", code)
            .when(kind == "iban", country),
        ).alias("tweak"),
    )
    card = lambda body: F.pmod(-_luhn(body, False), F.lit(10))
    account = lambda rest: F.lit(98) - _iban_rest(F.concat(country, F.lit("00"), rest))

    def closed(old: Column, new: Column) -> Column:
        check = F.pmod(card(new) + _off(F.substring(value, -1, 1), card(old), 10), F.lit(10))
        checks = F.pmod(account(new) + _off(F.substring(value, 3, 2), account(old), 100), F.lit(100))
        hosts = _moved(host, key, F.concat(F.lit("host\x1f"), ending))
        return (
            F.when(kind == "email", F.concat(new, F.when(plain, "").otherwise("%"), F.lit("@"), hosts, ending))
            .when(kind == "phone", F.concat(code, F.lit("|"), code, new))
            .when(kind == "card", F.concat(new, check.cast("string")))
            .when(kind == "iban", F.concat(country, F.lpad(checks.cast("string"), 2, "0"), new))
            .otherwise(new)
        )

    return _bound(inside, lambda g: _bound(_moved(g["text"], key, g["tweak"]), lambda new: closed(g["text"], new)))


def _numbered_value(key: str, kind: Column, value: Column) -> Column:
    """The surrogate of an IP address.

    Bytes become other bytes and larger numbers other larger ones. Groups of zeros in
    addresses of version 6 stay, as they may be left out.
    """
    six = kind == "ip6"
    parts = F.when(six, F.transform(F.split(value, ":"), lambda g: F.conv(g, 16, 10).cast("int"))).otherwise(_octets(value))

    def moved(given: Column) -> Column:
        base = lambda v: F.when(six, F.when(v == 0, 0).otherwise(1)).otherwise(F.when(v < 256, 0).otherwise(256))
        sizes = lambda v: F.when(six, F.when(v == 0, 1).otherwise(65535)).otherwise(F.when(v < 256, 256).otherwise(744))
        low = F.transform(given, lambda v: v - base(v))
        new = F.zip_with(_permuted(low, F.transform(given, sizes), key, kind), given, lambda n, v: n + base(v))
        return F.when(
            six, F.array_join(F.transform(new, lambda v: F.lpad(F.lower(F.hex(v)), 4, "0")), ":")
        ).otherwise(F.array_join(new.cast("array<string>"), "."))

    return _bound(parts, moved)


#: Kinds of names that are drawn.
DRAWN = "^(given_[mfx]|surname)"


def drawn_name(key: str, kind: Column, value: Column, attempt: Column) -> Column:
    """The surrogate of a given name or a surname."""
    seed = F.sha2(F.concat_ws("\x1f", F.lit(key), kind, value, attempt.cast("string")), 512)

    def choose(s: Column) -> Column:
        listed = None
        for script, names in (("", GIVEN), ("_cyrillic", GIVEN_CYRILLIC)):
            for gender in "mfx":
                fits = (kind == f"given_{gender}{script}") & (attempt == 0)
                name = _chosen(names[gender], s)
                listed = F.when(fits, name) if listed is None else listed.when(fits, name)
        return listed.otherwise(_drawn(kind, s, F.when(kind.startswith("surname"), attempt + 3).otherwise(attempt + 1)))

    return _bound(seed, choose)


def surrogate(key: str, kind: Column, value: Column, attempt: Column) -> Column:
    """The normal form of the surrogate of an entity. Only names need attempts."""
    return (
        F.when(kind.rlike(DRAWN), drawn_name(key, kind, value, attempt))
        .when(kind == "given_initial", _other_initials(key, value))
        .when(kind.isin("ip", "ip6"), _numbered_value(key, kind, value))
        .otherwise(_written_value(key, kind, value))
    )


def _in_format(kind: Column, original: Column, normal: Column) -> Column:
    """The normal form of a surrogate, written like the original."""
    digits = F.substring_index(normal, "|", -1)
    nth = lambda i: F.length(_digits(F.substring(original, F.lit(1), i)))
    spaced = _each(
        original, lambda c, i: F.when(c.rlike("[0-9]"), F.substring(digits, nth(i), F.lit(1))).otherwise(c)
    )
    letter = lambda i: F.length(F.regexp_replace(F.substring(original, F.lit(1), i), " ", ""))
    grouped = _each(original, lambda c, i: F.when(c == " ", c).otherwise(F.substring(normal, letter(i), F.lit(1))))
    shouted = (F.upper(original) == original) & (F.lower(original) != original)
    left, right = _groups(original)
    groups = F.transform(F.split(normal, ":"), lambda g: F.when(g == "0000", F.lit("0")).otherwise(g))
    behind = F.slice(groups, F.size(groups) - F.size(right) + 1, F.size(right))
    address = F.when(
        original.contains("::"),
        F.concat(F.array_join(F.slice(groups, F.lit(1), F.size(left)), ":"), F.lit("::"), F.array_join(behind, ":")),
    ).otherwise(F.array_join(groups, ":"))
    return (
        F.when(kind == "email", F.when(shouted, F.upper(normal)).otherwise(normal))
        .when(kind == "ip6", F.when(shouted, F.upper(address)).otherwise(address))
        .when(kind == "ip", normal)
        .when(kind == "iban", grouped)
        .otherwise(spaced)
    )


def replaced(text: Column, found: Column, key: str, attempt) -> Column:
    """A text with surrogates in place of its mentions; ``attempt(entity)`` gives the attempts."""

    def written(m: Column) -> Column:
        normal = F.transform(
            m["entities"], lambda e: surrogate(key, e["kind"], e["value"], attempt(e))
        )
        cased = F.zip_with(
            normal, _name_parts(m["original"]), lambda n, w: F.when(F.upper(w) == w, F.upper(n)).otherwise(n)
        )
        gaps = F.split(_name(m["original"]), _NAME_PART, -1)
        name = F.concat(
            _title(m["original"]), F.array_join(F.zip_with(cased, gaps, lambda n, gap: F.concat(gap, n)), "")
        )
        return F.when(m["kind"] == "name", name).otherwise(
            _in_format(m["kind"], m["original"], F.element_at(normal, 1))
        )

    between = F.split(text, PATTERN, -1)
    tail = F.slice(between, F.lit(2), F.greatest(F.size(between) - 1, F.lit(0)))
    joined = F.zip_with(F.transform(found, written), tail, lambda s, rest: F.concat(s, rest))
    return F.when(F.size(found) > 0, F.concat(F.element_at(between, 1), F.array_join(joined, ""))).otherwise(text)


def attempts(entities: DataFrame, key: str) -> DataFrame:
    """The names (kind, value) that need more than one attempt, with their number of attempts.

    A round groups the surrogates of all names and draws again for those that are equal to
    another's, but for the first of each group. Surrogates are worked out once a round, by
    tasks of ``NAMES_A_TASK`` names, and stored.
    """

    def drawn(names: DataFrame) -> DataFrame:
        made = drawn_name(key, F.col("kind"), F.col("value"), F.col("attempt"))
        return names.select("kind", "value", "attempt", made.alias("made"))

    names = entities.filter(F.col("kind").rlike(DRAWN)).distinct()
    names = common.stored(names.withColumn("attempt", F.lit(0)), "names")
    tasks = names.count() // NAMES_A_TASK + 1
    table = common.stored(drawn(names.repartition(tasks, "kind", "value")), "drawn")
    while True:
        clashes = table.groupBy("kind", "made").agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("first"))
        joined = table.join(clashes.filter("n > 1").drop("n"), ["kind", "made"], "left")
        told = common.stored(
            joined.select("kind", "value", "attempt", "made", F.coalesce(F.col("value") != F.col("first"), F.lit(False)).alias("again")),
            "told",
        )
        again = told.filter("again").select("kind", "value", (F.col("attempt") + 1).alias("attempt"))
        n = again.count()
        if not n:
            return told.filter("attempt > 0").select("kind", "value", "attempt")
        moved = drawn(again.repartition(n // NAMES_A_TASK + 1, "kind", "value"))
        table = common.stored(told.filter("NOT again").drop("again").unionByName(moved), "drawn")


def pseudonymised(docs: DataFrame, key: str = KEY) -> DataFrame:
    """One row per document: doc_id, text with surrogates, n_mentions and the kinds met."""
    rows = docs.select("doc_id", "text").withColumn("found", mentions(F.col("text")))
    entities = rows.select(F.explode("found.entities").alias("e")).select(F.inline("e"))
    later = attempts(entities, key)
    if later.isEmpty():
        done = rows.withColumn("new_text", replaced(F.col("text"), F.col("found"), key, lambda e: F.lit(0)))
    else:
        mark = F.xxhash64("text").alias("mark")
        told = (
            rows.select("doc_id", mark, F.explode("found.entities").alias("e"))
            .select("doc_id", "mark", F.inline("e"))
            .join(later, ["kind", "value"])
            .groupBy("doc_id", "mark")
            .agg(
                F.map_from_entries(
                    F.collect_set(F.struct(F.concat_ws("\x1f", "kind", "value"), "attempt"))
                ).alias("tries")
            )
        )
        known = rows.withColumn("mark", F.xxhash64("text")).alias("r").join(
            told.alias("t"),
            F.col("r.doc_id").eqNullSafe(F.col("t.doc_id")) & (F.col("r.mark") == F.col("t.mark")),
            "left",
        )
        tries = F.col("t.tries")
        done = known.select("r.doc_id", "r.text", "r.found", "t.tries").withColumn(
            "new_text",
            replaced(
                F.col("text"),
                F.col("found"),
                key,
                lambda e: F.coalesce(F.element_at(F.col("tries"), F.concat_ws("\x1f", e["kind"], e["value"])), F.lit(0)),
            ),
        )
    kinds = F.array_distinct(F.transform("found", lambda m: m["kind"]))
    return done.select(
        "doc_id",
        F.col("new_text").alias("text"),
        F.coalesce(F.size("found"), F.lit(0)).alias("n_mentions"),
        kinds.alias("kinds"),
    )
