"""Small texts with every awkward case."""

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, node bigint, part int, ids string"


def vocabulary(seed: int, n: int = 400) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefghilmnorstué") for _ in range(rng.randint(2, 9))) for _ in range(n)]


def prose(seed: int, n: int) -> str:
    rng, names = random.Random(seed), vocabulary(1)
    return " ".join(rng.choice(names) for _ in range(n))


def rows(texts: list[str | None], first_id: int = 0) -> list[tuple]:
    """Documents with columns whose names clash with those that operators use inside."""
    return [(first_id + i, t, "en" if i % 2 else None, "s", None, "k", 7, 1, "x") for i, t in enumerate(texts)]


def awkward() -> list[str | None]:
    base = prose(5, 300)
    changed = base.split(" ")
    changed[40] = "Other"
    return [
        None,
        "",
        " \t\n\x0b ",
        "one",
        "One two",
        base,
        base,
        " ".join(changed),
        base.upper(),
        prose(6, 5000),
        "x" * 100_000,
        "na " * 3000,
        "line 1 of 7\nline 2 of 7\n\n\nline 3 of 7",
        "İstanbul ǅ <|endoftext|> don't é \U0001f600 日本語\r\nend",
        base + "\n" + prose(9, 20),
        prose(9, 20),
    ]
