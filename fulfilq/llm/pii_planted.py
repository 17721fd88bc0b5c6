"""Made personal data for training: forms that the rules know, forms they miss, and numbers that are none.

The forms are rules of writing, drawn with a seeded generator; words around and
inside them come from the corpus.
"""

from __future__ import annotations

TLD = ("com", "org", "net", "de", "fr", "es", "io", "info")
#: (at, dot) of a spelt-out address.
SPELT = ((" at ", " dot "), ("[at]", "[dot]"), (" [at] ", " [dot] "), ("(at)", "(dot)"), (" (at) ", " (dot) "), (" AT ", " DOT "), ("@", " dot "), (" @ ", " . "))


def digits(rng, n: int) -> str:
    return "".join(map(str, rng.integers(0, 10, n)))


def pick(rng, options):
    return options[int(rng.integers(0, len(options)))]


def card_digits(rng) -> str:
    n = 16 if rng.random() < 0.7 else int(rng.integers(13, 20))
    body = pick(rng, "456") + digits(rng, n - 2)
    total = sum(int(d) if i % 2 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(body)))
    return body + str(-total % 10)


def groups(text: str, sep: str) -> str:
    return sep.join(text[i : i + 4] for i in range(0, len(text), 4))


def email(rng, words, hard: bool) -> str:
    at, dot = pick(rng, SPELT) if hard else ("@", ".")
    local = pick(rng, words) + pick(rng, ("", "", digits(rng, 2), "." + pick(rng, words), "_" + pick(rng, words)))
    host = [pick(rng, words)] + ([pick(rng, words)] if rng.random() < 0.3 else []) + [pick(rng, TLD)]
    return local + at + dot.join(host)


def ip(rng, words, hard: bool) -> str:
    return pick(rng, (" . ", "[.]", "(.)", " dot ", ". ") if hard else (".",)).join(str(x) for x in rng.integers(0, 256, 4))


def card(rng, words, hard: bool) -> str:
    return groups(card_digits(rng), pick(rng, (".", "_", "  ", " - ", "/") if hard else (" ", "-", "")))


def phone(rng, words, hard: bool) -> str:
    a, b, c = digits(rng, 3), digits(rng, 3), digits(rng, 4)
    country = pick(rng, "123456789") + digits(rng, int(rng.integers(0, 2)))
    if hard:
        return pick(rng, (f"({a}) {b}-{c}", f"{a}.{b}.{c}", f"00{country} {a} {b}{c}", f"00{country}-{a}-{b}-{c}", f"1-{a}-{b}-{c}",
                          f"+{country}/{a}/{b}{c}", f"({a}) {b} {c}", f"0{a[1:]}/{b}{c}"))
    return pick(rng, (f"+{country} ({a}) {b}-{c}", f"+{country} {a} {b} {c}", f"+{country}-{a}-{b}-{c}", f"+{country}.{a}.{b}{c}", f"+{country}{a}{b}{c}"))


FORMS = {"email": email, "ip": ip, "card": card, "phone": phone}


def number(rng) -> str:
    """A number that is no personal data."""
    return pick(rng, (
        digits(rng, int(rng.integers(1, 9))), f"{rng.integers(1900, 2100)}-{rng.integers(1, 13):02}-{rng.integers(1, 29):02}",
        f"{rng.integers(1, 29)}.{rng.integers(1, 13)}.{rng.integers(1900, 2100)}", f"{rng.integers(1, 20)}.{rng.integers(0, 20)}.{rng.integers(0, 20)}",
        f"{rng.integers(0, 1000)}.{digits(rng, 2)}", f"{rng.integers(1, 999)},{digits(rng, 3)},{digits(rng, 3)}",
        f"{rng.integers(0, 24):02}:{rng.integers(0, 60):02}:{rng.integers(0, 60):02}", f"#{digits(rng, 6)}", f"${rng.integers(1, 10**6)}",
        f"{rng.integers(1, 100)} %", f"@{pick(rng, TLD)}", f"{digits(rng, 3)}-{digits(rng, 2)}", f"v{rng.integers(1, 9)}.{rng.integers(0, 99)}",
    ))
