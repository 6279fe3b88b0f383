"""Garbled text: exact round trips on held-out words, and right text left alone."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from leafmill.llm import charset as C

DE = "für über können größer Änderung Übersicht Straße müssen während gemäß schließt nächsten Gerät ändern Höhe Zähler Prüfpuffer löscht überträgt Rückgabe"
FR = "été après très élève garçon français même côté fenêtre caractère mémoire réseau répertoire périphérique différée complète libère intègre sélectionnés"
RU = "система файл память указатель значение ключ данных объект очередь поток сообщение журнал событий счётчик кадров передаёт удаляет перед вызовом"
PL = "pamięć ścieżka długość główne łącze wątek źródło żądany następną wartość przesyła odświeża zamknięciem każdej własny narzędzi"


@pytest.fixture(scope="module")
def model():
    rng = random.Random(1)
    counts = Counter()
    for lang in (DE, FR, RU, PL):
        for w in lang.split():
            if not w.isascii():
                counts[w] += rng.randint(5, 60)
    counts.update({"–": 300, "’s": 20, "À": 10, "Â": 10, "Ã": 10, "§": 10, "┌──┐": 12, "│ok│": 12, "└──┘": 12, "SÃO": 5, "ÂU": 5})
    return C.train(counts)


def test_chains_invert_what_they_garble():
    for chain in C.ALL:
        for text in ("größer", "même", "ключ", "żądany", "画面"):
            made = chain.garble(text)
            if made is not None and made != text:
                assert chain.invert(made) == text


@pytest.mark.parametrize("lang", [DE, FR, RU, PL])
@pytest.mark.parametrize("chain", ["utf-8>cp1252", "utf-8>latin-1", "utf-8>cp437", "utf-8>mac_roman", "utf-8>cp1250", "utf-8>cp1252 twice", "utf-8>cp1251"])
def test_restores(model, lang, chain):
    own = next(c for c in C.ALL if c.name == chain)
    words = lang.split()
    bad = " ".join(own.garble(w) or w for w in words)
    found = C.examine(bad, model)
    assert found is not None
    right = sum(a == b for a, b in zip(found.restored.split(" "), words))
    assert right >= 0.9 * len(words), found.restored


@pytest.mark.parametrize(("lang", "chain"), [(RU, "koi8-r>cp1251"), (RU, "cp1251>cp1252"), (DE, "cp1252>cp437"), (FR, "cp1252>cp850"), (PL, "cp1250>cp1252")])
def test_restores_single_byte_chains(model, lang, chain):
    own = next(c for c in C.ALL if c.name == chain)
    words = lang.split()
    found = C.examine(" ".join(own.garble(w) or w for w in words), model)
    assert found is not None
    assert sum(a == b for a, b in zip(found.restored.split(" "), words)) >= 0.8 * len(words), found.restored


@pytest.mark.parametrize("text", [DE, FR, RU, PL, "À Á Â Ã", "§ ¶ ¤", "┌──┐ │ok│ └──┘", "plain", "&eacute; &amp; &lt;", "SÃO ÂU", "100 °C ± 3 – «x»", ""])
def test_right_text_is_left_alone(model, text):
    assert C.examine(text, model) is None


# Right sentences in languages the sample lacks.
RIGHT = """Příliš žluťoučký kůň úpěl ďábelské ódy a paměť počítače byla při čtení téměř vyčerpána
Kŕdeľ šťastných ďatľov učí pri ústí Váhu mĺkveho koňa obhrýzať kôru a žrať čerstvé mäso
Kæmi ný öxi hér ykist þjófum nú bæði víl og ádrepa því það er góð hugmynd að bíða
Quizdeltagerne spiste jordbær med fløde mens cirkusklovnen spillede på xylofon når det blev mørkt
Vår særgode far brukte både blåbær og rødgrøt når han spiste på sjøen
Flygande bäckasiner söka hwila på mjuka tuvor där över åar och sjöar
Törkylempijävongahdus on hyvä sana kun näppäimistö häviää näytön päältä
Árvíztűrő tükörfúrógép és egy hűtőház kőből épült a győri út végén
Pijamalı hasta yağız şoföre çabucak güvendi ve İstanbul ığdır yolunu gösterdi
Înjurând pițigăiat zoofobul comandă vexat whisky și tequila în oraș după-amiază
Gojazni đačić s biciklom drži hmelj i finu vatu u džepu nošnje čekajući šešir
Glāžšķūņa rūķīši dzērumā čiepj Baha koncertflīģeļu vākus ļoti ātri
Įlinkdama fechtuotojo špaga sublykčiojusi pragręžė apvalų arbūzą ir ėjo žemyn
Luís argüia à Júlia que «brações, fé, chá, óxido, pôr, zângão» eram palavras do português
Perché la città è più bella così com'è, là dove già c'è virtù e bontà
Ξεσκεπάζω την ψυχοφθόρα βδελυγμία και η μνήμη του υπολογιστή δεν επαρκεί
Чуєш їх, доцю, га? Кумедна ж ти, прощайся без ґольфів! Більше пам’яті немає
Жълтата дюля беше щастлива, че пухът, който цъфна, замръзна като гьон
Љубазни фењерџија чађавог лица хоће да ми покаже штос ђака џепова
Do bạch kim rất quý nên sẽ dùng để lắp vô xương và bộ nhớ không đủ
我能吞下玻璃而不伤身体。内存不足，无法打开文件。
키스의 고유조건은 입술끼리 만나야 하고 특별한 기술은 필요치 않다
Ñuñez, Åström, Šašek, Đorđević, Ørsted, Çelik, Þórsson, Erdős, Gödel, Peña
╗ ╔══╗ ║ok║ ╚══╝ ══╗ ┌─┐ ░ ½ ² ³ µs ° ± × ÷ ≤ ≥ ≠ → ← √2 ∞ ∑ π α β Ω ® ™""".splitlines()


@pytest.mark.parametrize("text", RIGHT)
def test_right_text_of_other_languages_is_left_alone(model, text):
    assert C.examine(text, model) is None
    touched = [w for w in text.split() if not w.isascii() and C.examine(w, model)]
    assert not touched, touched


@pytest.mark.parametrize("text", RIGHT[:20])
@pytest.mark.parametrize("chain", ["utf-8>cp1252", "utf-8>latin-1", "utf-8>cp437", "utf-8>mac_roman"])
def test_garbled_text_of_other_languages_is_found(model, text, chain):
    own = next(c for c in C.ALL if c.name == chain)
    found = C.examine(" ".join(own.garble(w) or w for w in text.split()), model)
    assert found is not None and sum(a == b for a, b in zip(found.restored.split(), text.split())) >= 0.9 * len(text.split()), found.restored


@pytest.mark.parametrize("text", ["cаtаlog", "еnumеrаtіon оf ѕigned vоlаtіlе", "the\xa0mirrored modem\xa0resizes", "rеѕіdеnt", "PelMарSlоtА", "a\u2005b c\u3000d", "float\xad\ning int\xad\neger att\xad\nach doc\xad\nument", "┌──┐ │ok│ └──┘ ├──┤ ╔═╗"])
def test_blanks_and_look_alike_letters_are_not_garbled(model, text):
    assert C.examine(text, model) is None


def test_oddness_is_of_no_language():
    assert [C.oddness(w) for w in ("žluťoučký", "Ñuñez,", "ВОДЫ", "10µm", "«да»", "║ok║", "Δt", "SQLファイル", "iÓ", "f├╝r", "е貌z", "grÃ¶ÃŸer", "Ԡbelské", "pam\u061c", "═ͻ")] == [0] * 8 + [1, 1, 1, 2, 1, 1, 1]


@pytest.mark.parametrize("chain", ["utf-8>cp1252", "utf-8>cp437", "utf-8>cp1251", "utf-8>koi8-r"])
def test_garbling_anywhere_in_a_long_token(model, chain):
    own = next(c for c in C.ALL if c.name == chain)
    right = "これは最後の登録が必要です。ファイルを同期しますメッセージの文字は自動的に一覧のキーです。" * 4
    learnt = C.train(Counter({right[k : k + 45]: 20 for k in (0, 20, 45)} | {"für": 9, "ключ": 9}))
    for at in range(0, len(right) - 12, 7):
        found = C.examine(right[:at] + own.garble(right[at : at + 12]) + right[at + 12 :], learnt)
        assert found is not None and found.restored == right


def test_partly_entities_and_lost(model):
    found = C.examine("für das grÃ¶ÃŸer Gerät", model)
    assert found.restored == "für das größer Gerät" and found.n_garbled == 1
    found = C.examine("gr&Atilde;&para;&Atilde;&#376;er", model)
    assert found.restored == "größer" and found.chain.endswith("in entities")
    found = C.examine("das Ger��t", model)
    assert (found.chain, found.n_lost) == ("lost", 1)


@pytest.mark.parametrize("tail", ["ファイルの画面を登録", "für größer"])
def test_garbled_after_many_right_characters_of_a_token(tail):
    right = "これは最後の登録が必要です。ファイルを同期しますメッセージの文字は自動的に一覧のキーです。" * 3
    model = C.train(Counter({w: 20 for w in (right[:45], "für", "größer", "画面を登録")}))
    own = next(c for c in C.ALL if c.name == "utf-8>cp1252")
    tail = tail.replace(" ", "")
    found = C.examine(right + own.garble(tail) + "。", model)
    assert found is not None and found.restored == right + tail + "。"
    assert C.examine(right + tail, model) is None
    assert [set(range(n)) - {k + i for k in range(0, max(1, n - 30), 30) for i in range(60)} for n in (59, 60, 61, 90, 91, 600)] == [set()] * 6
    assert all("".join(w[-30:] if k else w for k, w in enumerate(C.windows(t))) == t for t in (right[:60], right[:90], right[:120]))


def test_signs_alone_are_counted_over_all_rows_and_by_ratio(spark):
    rows = [(k, "printer – even ± 1" if k < 178 else "right × one", None) for k in range(300)] + [(400, "printer û even", "— x é\x0b–")]
    df = spark.createDataFrame(rows, "page_id long, body string, title string")
    assert C.lone_counts(df, ["title", "body"]) == {"–": 179, "±": 178, "×": 122, "û": 1, "—": 1, "é": 1}
    model = C.train(Counter({"für": 5}), lone=C.lone_counts(df, ["title", "body"]))
    assert C.examine("printer û even", model).restored == "printer – even"
    assert C.examine("rated ▒ 1", model).restored == "rated ± 1"  # a sign that became another sign
    assert C.examine("printer û even", C.train(Counter({"für": 5}), lone={"–": 178, "û": 2})) is None


def test_sums_are_those_of_each_token_garbled():
    words = [w for w in " ".join([DE, FR, RU, PL, *RIGHT]).split() if not w.isascii()][:250]
    words = list(dict.fromkeys([*words, *filter(None, (c.garble(w) for w in words[:30] for c in C.ALL[::4])), "İİx", "a\x02é\x03", "Σας", "😀é", "ﬁé"]))
    weight = np.arange(1.0, len(words) + 1)
    tables, letters = C.sums_of(words, weight)
    for c, table in enumerate(tables):
        made = words if c == 0 else [C.ALL[c - 1].garble(w) for w in words]
        kept = [k for k, (t, o) in enumerate(zip(made, words)) if t is not None and (c == 0 or t != o)]
        at, starts = C.features([made[k] for k in kept])
        assert (table == np.bincount(at, np.repeat(weight[kept], np.diff(np.append(starts, len(at)))), C.BUCKETS)).all()
    pairs = [[(ord(a) * 1_000_003 + ord(b)) * 2_654_435_761 % (1 << 32) >> 14 for a, b in zip("\x02" + w.lower(), w.lower() + "\x03")] for w in words]
    assert (letters == np.bincount(sum(pairs, []), np.repeat(weight, list(map(len, pairs))), len(letters))).all()


def test_tokens_are_runs_without_blanks():
    text = "für\tÜber\r\na\xa0b \x0c\x0b  é\n\nplain x\u3000\u2028y\x1cé " + "a" * 100_000 + " ü"
    assert C.tokens_of(text) == ["für", "Über", "a\xa0b", "é", "x\u3000\u2028y\x1cé", "ü"] and C.tokens_of("") == C.tokens_of(" a ") == []


def test_long_runs_of_ascii_take_no_longer_than_others(model):
    import time

    began, long = time.time(), "a" * 300_000
    assert C.examine(f"{long} fÃ¼r {long}", model).restored == f"{long} für {long}"
    assert time.time() - began < 5


def test_model_is_of_all_rows(spark):
    words = (DE + " " + FR + " " + RU).split()
    rows = [(i, " ".join(words[i % 9 :: 3]), "größer" * 15 if i % 7 else "fÃ¼r") for i in range(200)]
    counts = Counter(t for _, *texts in rows for text in texts for t in C.tokens_of(text))
    own, local = C.fitted(spark.createDataFrame(rows, "page_id long, body string, title string"), ["title", "body"]), C.train(counts)
    assert np.allclose(own.table, local.table, atol=1e-5) and np.allclose(own.letters, local.letters, atol=1e-5) and own.lone == local.lone
    assert all(w in own.words for w in local.words) and len(own.words.hashes) == len(local.words)
    assert "für" in own.words and "fã¼r" not in own.words
    # More rows and different words than were ever sampled: each counts, though it is in one row only.
    df = spark.range(20_000).select("id", F.format_string("wört%d", "id").alias("body"))
    model = C.fitted(df, ["body"])
    assert all(f"wört{i}" in model.words for i in range(20_000)) and "wört20000" not in model.words


def test_utf8_that_lost_a_byte_is_not_taken_for_another_encoding(model):
    assert C.examine("der błÄ\x85d wątek", model).restored == "der błąd wątek"


def test_columns(spark):
    words = (DE + " " + FR).split()
    rows = [(i, " ".join(words[i % 9 :: 3]), "Gerät", 1) for i in range(60)]
    rows += [(90, "fÃ¼r nÃ¤chsten", None, 1), (91, None, "", 1), (90, "fÃ¼r nÃ¤chsten", None, 1)]
    df = spark.createDataFrame(rows, "page_id long, body string, title string, chain int")
    got = C.restored_fields(df, "page_id", ["title", "body"]).collect()
    assert [(r["page_id"], r["field_name"], r["restored"]) for r in got] == [(90, "body", "für nächsten")] * 2
    assert C.restored_fields(df.where("false"), "page_id", ["title", "body"]).count() == 0
