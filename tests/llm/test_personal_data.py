import random
import re

from plenum.llm.personal_data import KINDS, Finder, digests, luhn


def brute(text):
    """Each base kind by scanning with its whole pattern."""
    found = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m.group().split(".")):
            found.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


def base(find, text):
    return [tuple(s) for s in find(text) if s.kind < 4]


def test_base_spans_equal_the_patterns_on_random_texts():
    find, rng = Finder(), random.Random(7)
    pieces = ["a@b.co", "@", "x.y+z@q-1.de.", "10.0.0.1", "256.1.1.1", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (555) 555-1234", "+12", "+", " ", "\n", "é", "..", "-", "7", "00000", ")", "9876543210", "@b", "a@b@c.d", "."]
    for _ in range(4000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 14)))
        assert base(find, text) == brute(text), text


def test_edges():
    find = Finder()
    assert find("") == []
    assert digests([]) == ([0, 0, 0, 0], "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855", "")
    long = "1" * 3_000 + "." * 3 + "@" * 3_000 + "a" * 3_000 + "+1" * 2_000
    assert base(find, long) == [(s, k, e) for s, k, e in brute(long)]


def test_added_kinds():
    find = Finder()
    kinds = lambda text: [KINDS[s.kind] for s in find(text)]
    assert kinds("IBAN: DE89 3704 0044 0532 0130 00 ok") == ["iban"]
    assert "account" in kinds("account no: 12345678")
    assert kinds("see https://joe:pw@host.example/x")[0] == "login"
    assert kinds("thanks @someone for it") == ["handle"]
    assert kinds("The account was closed in the town.") == []


def test_ibans_end_before_a_capital_word():
    find, rng = Finder(), random.Random(11)
    found = lambda text: [text[s.start : s.end] for s in find(text) if KINDS[s.kind] == "iban"]
    assert found("IBAN: ES91 2100 0418 4502 0005 1332 BIC X") == ["ES91 2100 0418 4502 0005 1332"]
    for _ in range(2_000):
        country, size = rng.choice([("ES", 24), ("AT", 20), ("PL", 28), ("BE", 16), ("LC", 32), ("DE", 22), ("MT", 31), ("NO", 15)])
        body = "".join(rng.choices("0123456789", k=size - 4))
        code = f"{country}{98 - int(''.join(str(int(c, 36)) for c in body + country + '00')) % 97:02d}{body}"
        shown = rng.choice([code, " ".join(code[k : k + 4] for k in range(0, size, 4))])
        tail = rng.choice(["", ".", " ok", " BIC", " EUR 5", " EURO", " BANK AUSTRIA", " BIC GIBA ATWW XXX", " 12", "\nBIC"])
        assert found(f"IBAN: {shown}{tail}") == [shown], (shown, tail)
    assert found("IBAN: ES91 2100 0418 4502 0005 1333 BIC X") == []
