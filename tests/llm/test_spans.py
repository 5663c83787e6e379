import random
import re

from thermocline.llm import pii, secrets
from thermocline.llm.spans import Covered


def luhn(digits):
    total = 0
    for k, c in enumerate(digits[::-1]):
        n = int(c) * (2 if k % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def plain_pii(t):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        digits = re.sub("[^0-9]", "", m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]


def plain_secrets(t):
    both = lambda w: "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w)
    words = "|".join([*map(both, ("password", "passwd", "secret", "token")), "[aA][pP][iI]_?[kK][eE][yY]"])
    out = [("assign", *m.span()) for m in re.finditer(rf"""({words})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t) if len(m[2]) >= 12]
    out += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
    out += [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 16]
    return sorted(out, key=lambda s: (s[1], secrets.BASE.index(s[0])))


def texts(spark, sf):
    rnd = random.Random(3)
    out = [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    out += ["".join(rnd.choice("01234567890 .-+()@ab.c-1.2.3.4,_%é") for _ in range(rnd.randint(1, 200))) for _ in range(1500)]
    parts = ["token", "Token", "api_key", "apikey", "passwd", " ", "=", ":", '"', "'", "abc1", "AKIA", "AKIAB", "F00", "0af", "de1", "/x", "-", "_", "ſecret", "toKen"]
    return out + ["".join(rnd.choice(parts) for _ in range(rnd.randint(1, 60))) for _ in range(1500)] + ["9" * 5000, "1." * 5000, "+1" + " " * 5000, "4111 1111 1111 1111", "0." * 3 + "0"]


def test_base_spans(spark, sf):
    for module, plain in ((pii, plain_pii), (secrets, plain_secrets)):
        find = module.finder()
        for t in texts(spark, sf):
            assert [s for s in find(t) if s[0] in module.BASE] == plain(t), t[:200]


def test_added_personal_data():
    find = lambda t: [(k, t[a:b]) for k, a, b in pii.finder()(t)]
    assert find("IBAN: DE89 3704 0044 0532 0130 00.") == [("account", "DE89 3704 0044 0532 0130 00")]
    assert find("IBAN: DE88 3704 0044 0532 0130 00.") == []
    assert find("account number: 123-456-789, recount 55555555") == [("account", "123-456-789")]
    assert find("see https://a.example.com/x?y=1, or ftp://h/ x") == [("address", "https://a.example.com/x?y=1")]
    assert find("@someone wrote to me@example.com") == [("email", "me@example.com"), ("account", "@someone")]


def test_added_secrets():
    find = lambda t: [(k, t[a:b]) for k, a, b in secrets.finder()(t)]
    assert find("key kJ8s0Qz7Lp2Vb9Xn4Rt6Yw1 end") == [("entropy", "kJ8s0Qz7Lp2Vb9Xn4Rt6Yw1")]
    assert find("kJ8s0Qz7Lp2Vb9Xn4EXAMPLE and internationalizationfully and Z11111Z11111Z11111Z11111") == []
    assert find("1111111Z11Z22222Z222ZZZZZ11Z11") == []


def test_windows_as_counted_anew():
    import math
    from collections import Counter

    rnd = random.Random(4)
    for _ in range(200):
        t = "".join(rnd.choice("aabbcdefgh01") for _ in range(rnd.randint(0, 70)))
        for least in (2.0, 2.7, 3.1):
            covered = set()
            for k in range(len(t) - 19):
                counts = Counter(t[k : k + 20]).values()
                if -sum(n / 20 * math.log2(n / 20) for n in counts) >= least - 1e-9:
                    covered.update(range(k, k + 20))
            got = {x for a, b in secrets.entropy_spans(t, least) for x in range(a, b)}
            assert got == covered


def test_rows(make_docs, odd_rows):
    rows = [*odd_rows, (9, "a@b.example and 1.2.3.4 token = 0123456789abcdef0")]
    docs = make_docs(rows)
    for found in (pii.personal_data(docs), secrets.secrets(docs)):
        assert found.columns == [c for c in docs.columns if c != "spans"] + ["spans"]
        out = found.collect()
        assert len(out) == len(rows)
        assert {r["doc_id"] for r in out if r["spans"]} == {9}
    assert pii.personal_data(make_docs([])).count() == 0 and secrets.secrets(make_docs([])).count() == 0


def test_keys_beside_known_words():
    find = lambda t: [t[a:b] for _, a, b in secrets.finder()(t)]
    assert any("9f8Gk2LmQ0aZx81bYtRw" in s for s in find("v1/example-app/9f8Gk2LmQ0aZx81bYtRw"))
    assert any("xk29fj3kd9w8q7z6" in s for s in find("services/t024be7ld/b0k9v3x2q/xk29fj3kd9w8q7z6"))
    assert find("the kJ8s0Qz7Lp2Vb9 end") == ["kJ8s0Qz7Lp2Vb9"]
    assert find("well-known-facts user_account_id covid19update 1234567890123 some/long-path/page-12/of-it") == []


def test_more_identifiers():
    find = lambda t: [t[a:b] for k, a, b in pii.finder()(t) if k == "account"]
    assert find("routing number: 021000021") == ["021000021"] and find("routing number: 021000022") == []
    assert find("SWIFT: DEUTDEFF500 and swift reply") == ["DEUTDEFF500"]
    assert find("Passport no. C01X00T47, passport C1234567") == ["C1234567"]
    assert find("SSN 123-45-6789") == ["123-45-6789"] and find("SSN 000-45-6789") == []
    assert find("VAT: DE123456789; Customer ID #4711007") == ["DE123456789", "4711007"]
    assert find("protein 12345678, customers 12 and discounts 1234567") == []


def test_rest_beside_base_spans():
    find = lambda t: [(k, t[a:b]) for k, a, b in secrets.finder()(t)]
    mixed = "9f8a7b6c5d4e3f2a1bXq7ZkT2mRv9LpWs4YhNd8GjKe3Qc"
    assert find(mixed) == [("hex", mixed[:18]), ("entropy", mixed[18:])]
    assert find("pin code 839201746502") == [("entropy", "839201746502")]  # 16 digits and more are hex strings
    assert find("order 839201746502") == find("pin code 111122223333") == []


def test_covered():
    rnd = random.Random(3)
    for _ in range(300):
        spans = [(a, a + rnd.randint(1, 6)) for a in (rnd.randint(0, 40) for _ in range(rnd.randint(0, 8)))]
        covered = Covered(spans)
        held = {x for a, b in spans for x in range(a, b)}
        a = rnd.randint(0, 40)
        b = a + rnd.randint(1, 12)
        assert {x for p, q in covered.rest(a, b) for x in range(p, q)} == set(range(a, b)) - held
        assert covered.touches(a, b) == any(p < b and a < q for p, q in spans)


def test_many_spans_take_linear_time():
    import time

    page = "".join(f"u{k}@h{k}.example https://h{k}.example/p{k} kJ8s0Qz7Lp2Vb9Xn4Rt6Yw{k} token={k}aaaaaaaaaaaa9\n" for k in range(20_000))
    assert len(page) > 1_500_000
    for module in (pii, secrets):
        began = time.process_time()
        assert len(module.finder()(page)) >= 40_000
        assert time.process_time() - began < 15
