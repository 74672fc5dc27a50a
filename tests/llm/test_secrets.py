import random

from kpiweave.llm import secrets as S

DOCS = "doc_id bigint, text string, source string, n_chars bigint, is_secret string, _id int"


def corpus():
    rng = random.Random(4)
    words = [rng.choice("bcdfg") + rng.choice("aeiou") + rng.choice("lmnr") for _ in range(80)]

    def prose(n):
        return " ".join(rng.choice(words) for _ in range(n))

    rows, planted = [], {}
    for i in range(400):
        text = prose(40)
        if i % 8 == 0:
            value = "".join(rng.choice("0123456789abcdef") for _ in range(40))
            text += f' token = "{value}" ' + prose(5)
            planted[i] = value
        elif i % 8 == 1:
            text += " " + "".join(rng.choice(words) for _ in range(8)) + " " + prose(3)
        elif i % 8 == 2:
            text += " 4111111111111111 " + prose(3)
        elif i % 8 == 3:
            text += ' key: "' + "".join(rng.choice(words) for _ in range(8)) + '"'
        rows.append((i, text, "repo/src" if i % 2 else None, len(text), "x", 0))
    return rows, planted


def test_finds_planted_secrets_and_masks_only_them(spark):
    rows, planted = corpus()
    rows += [(900, None, None, None, None, 1), (901, "", "x", 0, None, 1), rows[0]]
    rows += [(None, rows[8][1], "y", 1, None, 1), (902, "ordinary " * 30000, "z", 9, None, 2)]
    docs = spark.createDataFrame(rows, DOCS)
    judged = S.scan(docs)
    flagged = {(r.doc_id, r.candidate) for r in judged.where("is_secret").collect()}
    expected = {(i, v) for i, v in planted.items()} | {(None, planted[8])}
    assert flagged == expected
    out = S.redact(docs, judged)
    assert out.columns == docs.columns and out.count() == len(rows)
    for r in out.collect():
        assert r.text is None or all(v not in r.text for v in planted.values())
        if r.doc_id in planted:
            assert S.MASK in r.text and r.n_chars == len(r.text)
    same = {r.doc_id: r.text for r in out.collect()}
    assert all(same[i] == t for i, t, *_ in rows if i not in planted and i is not None)


def forms(rng, i):
    """A secret of the form i, and the text around it."""
    lower, digits = "abcdefghijklmnopqrstuvwxyz", "0123456789"
    upper = lower.upper()

    def some(n, of):
        return "".join(rng.choice(of) for _ in range(n))

    password = f"{some(1, upper)}{some(2, lower)}{some(2, digits)}{some(3, lower)}&{some(1, digits)}x!"
    return [
        ("prefix in prose", v := "AKIA" + some(16, upper + digits), f"use {v} now"),
        ("unquoted", v := some(32, lower + digits), f"API_KEY={v}"),
        ("bearer", v := some(40, lower + upper + digits), f"Authorization: Bearer {v}"),
        ("url password", v := some(4, lower) + some(4, digits) + "x", f"postgres://bob:{v}@db.example/x"),
        ("url parameter", v := some(24, lower + digits), f"https://a.example/x?token={v}&y=1"),
        ("quoted password", password, f'password = "{password}"'),
        ("unquoted password", password, f"password: {password}"),
        ("told password", password, f"the password is {password} for now"),
        ("few digits", v := some(24, lower + upper), f'secret = "{v}"'),
    ][i]


def test_recall_of_each_form(spark):
    rng = random.Random(9)
    rows, planted, seen = corpus()[0], {}, {}
    for i in range(270):
        name, value, around = forms(rng, i % 9)
        rows.append((1000 + i, f"{rows[i][1][:100]} {around} {rows[i + 1][1][:60]}", "src", 1, "x", 0))
        planted[1000 + i] = (name, value)
    judged = S.scan(spark.createDataFrame(rows, DOCS))
    found = {(r.doc_id, r.candidate) for r in judged.where("is_secret").collect()}
    for i, (name, value) in planted.items():
        seen.setdefault(name, []).append((i, value) in found)
    recall = {name: sum(hits) / len(hits) for name, hits in seen.items()}
    print(recall)
    assert min(recall.values()) >= 0.9, recall


def unlabelled_forms(rng, i):
    """Secrets and, from 4 on, values that are none, in forms that no labelling rule knows."""
    lower, digits = "abcdefghijklmnopqrstuvwxyz", "0123456789"

    def some(n, of):
        return "".join(rng.choice(of) for _ in range(n))

    mixed = lower + lower.upper() + digits
    return [
        ("call", v := some(30, mixed), f'client.login("bob", "{v}")'),
        ("bare hexadecimal", v := some(48, "0123456789abcdef"), f"then paste {v} there"),
        ("list", v := some(32, mixed), f"keys: [{v}]"),
        ("tag", v := some(36, mixed), f"<signature>{v}</signature>"),
        ("path", v := "/".join(["usr", "lib", "bin", "share", "man", "doc"]), f"look in {v} first"),
        ("slug", v := "-".join(["dim", "ber", "con", "fan", "gor", "bul"]), f"see {v} again"),
        ("day", v := f"20{some(2, digits)}-0{rng.randint(1, 9)}-1{some(1, digits)}", f"on: {v}"),
        ("amount", v := some(3, digits) + "." + some(2, digits), f"total = {v}"),
        ("name", v := "bob_" + rng.choice(["fan", "gor", "bul"]), f"user = {v}"),
    ][i]


def test_forms_held_out_of_the_labels(spark):
    rng = random.Random(31)
    rows, secret, other = corpus()[0], {}, {}
    for i in range(270):
        _, value, around = forms(rng, i % 9)
        rows.append((1000 + i, f"{rows[i][1][:100]} {around} {rows[i + 1][1][:60]}", "src", 1, "x", 0))
        name, value, around = unlabelled_forms(rng, i % 9)
        rows.append((2000 + i, f"{rows[i][1][:100]} {around} {rows[i + 1][1][:60]}", "src", 1, "x", 0))
        (secret if i % 9 < 4 else other)[2000 + i] = name, value
    judged = S.scan(spark.createDataFrame(rows, DOCS))
    found = [(r.doc_id, r.candidate) for r in judged.where("is_secret AND doc_id >= 2000").collect()]
    hits = {}
    for i, (name, value) in (secret | other).items():
        hits.setdefault(name, []).append(any(j == i and value in c for j, c in found))
    rates = {name: sum(h) / len(h) for name, h in hits.items()}
    right = sum(i in secret and secret[i][1] in c for i, c in found)
    print(rates, right / len(found))
    assert right / len(found) >= 0.9
    assert sum(rates[n] for n in ("call", "bare hexadecimal", "list", "tag")) / 4 >= 0.7


def test_a_word_of_the_dictionary_is_in_a_share_of_the_documents(spark, monkeypatch):
    monkeypatch.setattr(S, "DOC_SHARE", 100)
    rows = [(i, f"common {'tenth' if i % 10 == 0 else 'x'}{' rare' if i < 5 else ''}", "s", 1, "", 0) for i in range(600)]
    assert S.profile(spark.createDataFrame(rows, DOCS)).words == {"common", "tenth"}


def test_candidates_of_any_length_and_character():
    for text, value in (
        ('password = "Tr0ub4dor&3x!"', "Tr0ub4dor&3x!"), ("x bob:p@s:s!w%d@host.example y", "p@s:s!w%d"),
        ("pin: 12ab", "12ab"), ("k = 'a'", "a"), ("ftp://u:a.b@h", "a.b"), ('"s": "two words."', "two words."),
    ):
        assert value in {text[a:b] for a, b in S._spans(text)}, text
    assert S._masked("abcdefgh", [{"start": 1, "size": 5}, {"start": 2, "size": 2}, {"start": 5, "size": 2}]) == "a[SECRET]h"


def test_profile_counts_every_text(spark):
    rows = [(i, f"common {'rareword' if i % 1000 == 0 else 'x'}", "s", 1, "", 0) for i in range(3000)]
    rows += [(5000 + i, "longtext " + "y " * 20000, "s", 1, "", 0) for i in range(3)]
    profile = S.profile(spark.createDataFrame(rows, DOCS))
    assert profile.words == {"common", "rareword", "longtext"}


def test_labelled_findings_decide(spark):
    rows, planted = corpus()
    docs = spark.createDataFrame(rows, DOCS)
    found = S.candidates(docs, S.profile(docs))
    # These findings call the long words secrets and the hexadecimal values none.
    label = found.selectExpr("*", "double(candidate RLIKE '^[a-z]+$') AS label")
    judged = S.scan(docs, label).where("is_secret").collect()
    assert judged and all(r.candidate.isalpha() for r in judged)


def test_no_candidates_and_empty_table(spark):
    for rows in ([], [(1, "a b c", "s", 5, None, 0)]):
        docs = spark.createDataFrame(rows, DOCS)
        assert S.report(docs).count() == 0
        assert S.redact(docs, S.scan(docs)).count() == len(rows)
