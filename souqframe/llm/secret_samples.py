"""Made-up secrets and what looks like them, put into windows of real text: what the field is taught with.

The base patterns find secrets behind a few keywords, AWS key ids and long lower-case hexadecimals. What is
made here are other kinds too (keys of services, signed tokens, base64, upper-case hexadecimals, passwords,
key blocks of several lines), in contexts that name them, name them in other words, or do not at all.
Things that are no secrets are put in as well, some of them behind the same keywords.
"""

import random

LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
BASE62 = LOWER + UPPER + DIGITS
BASE64, URL64 = BASE62 + "+/", BASE62 + "-_"
# What keys of services begin with.
PREFIXES = ["sk_live_", "pk_live_", "ghp_", "gho_", "glpat-", "xoxb-", "AIza", "SG.", "npm_", "key-", "rk_", "hf_"]
NAMED = [
    "password ", "Password is ", "passwd ", "pwd=", "secret ", "the secret is ", "token ", "Bearer ", "auth: ",
    "Authorization: Basic ", "credential ", "credentials: ", "api key ", "key: ", "KEY=", "login with ", "auth_key = ",
    "secret_key=", 'client_secret: "', "access key ", "PASSWORD=", "private key ",
]
UNNAMED = ["", "", "", "use ", "set to ", "it is ", "value ", "= ", ": ", '"', "(", "https://host.example/?x=", "curl -H "]
AFTER = [" ", ".", ",", '"', " and ", "\n", ")", ";", " today ", " for the "]
SHARE_NAMED = 0.6  # of strong secrets that come behind a word that names them


def _some(rnd: random.Random, letters: str, low: int, high: int) -> str:
    return "".join(rnd.choices(letters, k=rnd.randint(low, high)))


def service_key(rnd: random.Random) -> str:
    return rnd.choice(PREFIXES) + _some(rnd, BASE62, 16, 40)


def plain_key(rnd: random.Random) -> str:
    return _some(rnd, BASE62, 20, 44)


def signed_token(rnd: random.Random) -> str:
    return f"eyJ{_some(rnd, URL64, 17, 40)}.{_some(rnd, URL64, 30, 90)}.{_some(rnd, URL64, 30, 43)}"


def base64_key(rnd: random.Random) -> str:
    return _some(rnd, BASE64, 24, 88) + "=" * rnd.randint(0, 2)


def upper_hex(rnd: random.Random) -> str:
    return _some(rnd, DIGITS + "ABCDEF", 32, 64)


def base32_key(rnd: random.Random) -> str:
    return _some(rnd, UPPER + "234567", 16, 40)


def password(rnd: random.Random) -> str:
    made = [rnd.choice(UPPER), rnd.choice(LOWER), rnd.choice(DIGITS), *rnd.choices(BASE62, k=rnd.randint(5, 13))]
    rnd.shuffle(made)
    return "".join(made)


def letters_only(rnd: random.Random) -> str:
    return _some(rnd, LOWER + UPPER, 10, 24)


def key_block(rnd: random.Random) -> str:
    return "\n".join(_some(rnd, BASE64, 64, 64) for _ in range(rnd.randint(2, 6))) + "\n" + _some(rnd, BASE64, 8, 60) + "=="


STRONG = [service_key, plain_key, signed_token, base64_key, upper_hex, base32_key, key_block]
WEAK = [password, letters_only]  # only secret because of what stands in front of them


def secret(rnd: random.Random) -> tuple[str, str, str]:
    """What stands before a secret, the secret, and what stands behind it."""
    make = rnd.choice(STRONG * 2 + WEAK * 3)
    named = make in WEAK or rnd.random() < SHARE_NAMED
    return rnd.choice(NAMED if named else UNNAMED), make(rnd), rnd.choice(AFTER)


def _word(rnd: random.Random, low: int = 2, high: int = 12) -> str:
    return _some(rnd, LOWER, low, high)


def harmless(rnd: random.Random) -> str:
    """Something that is no secret."""
    kinds = [
        lambda: _some(rnd, DIGITS, 6, 19),
        lambda: f"{rnd.randint(1900, 2100)}-{rnd.randint(1, 12):02d}-{rnd.randint(1, 28):02d}",
        lambda: ".".join(str(rnd.randint(0, 255)) for _ in range(4)),
        lambda: f"v{rnd.randint(0, 20)}.{rnd.randint(0, 40)}.{rnd.randint(0, 9)}-rc{rnd.randint(1, 9)}",
        lambda: f"{_word(rnd)}{rnd.randint(1, 999)}@{_word(rnd)}.{rnd.choice(['com', 'org', 'example'])}",
        lambda: f"https://www.{_word(rnd)}.example/{_word(rnd)}/{_word(rnd)}.html",
        lambda: f"src/{_word(rnd)}/{_word(rnd).title()}{_word(rnd).title()}.java",
        lambda: f"{_word(rnd)}_{_word(rnd)}_{_word(rnd)}",
        lambda: _word(rnd).title() + _word(rnd).title() + _word(rnd).title(),
        lambda: _word(rnd, 14, 30),
        lambda: _word(rnd, 8, 20).upper(),
        lambda: f"+{rnd.randint(1, 99)}-{rnd.randint(100, 999)}-{rnd.randint(1000000, 9999999)}",
        lambda: f"{rnd.randint(1, 999)}.{rnd.randint(0, 99):02d}",
        lambda: f"{rnd.choice(['the password', 'a token', 'this secret', 'the key', 'your login'])} {_word(rnd)} {_word(rnd)}",
        lambda: f"{rnd.choice(['password', 'token', 'key', 'auth', 'credential'])} {rnd.randint(1, 9999)}",
        lambda: f"{rnd.choice(['password', 'secret', 'key', 'token'])}: {_word(rnd, 2, 5)}",
    ]
    return rnd.choice(kinds)() + rnd.choice([" ", ", ", ". ", "\n"])


def planted(window: str, rnd: random.Random) -> tuple[str, list[tuple[int, int]]]:
    """A window with up to two secrets and some harmless things put between its words, and where the secrets are."""
    words, out, spans, size = window.split(" "), [], [], 0
    places = sorted(rnd.choices(range(len(words) + 1), k=rnd.choice([0, 1, 1, 2])))
    beside = sorted(rnd.choices(range(len(words) + 1), k=rnd.randint(0, 4)))

    def put(part: str) -> None:
        nonlocal size
        out.append(part)
        size += len(part)

    for number in range(len(words) + 1):
        while beside and beside[0] == number:
            beside.pop(0)
            put(harmless(rnd))
        while places and places[0] == number:
            places.pop(0)
            before, made, after = secret(rnd)
            put(before)
            spans.append((size, size + len(made)))
            put(made + after)
        if number < len(words):
            put(words[number] + " ")
    return "".join(out), spans
