import time

import pytest

from tessellum.llm.sentences import Reader, Tally, split_sentences

# Documents with a bar where a sentence ends; the white space after it stays.
CASES = [
    "Le lot mesure 7,8 m sur 15,9 m, c.-à-d. moins que le minimum de l'art. 88.| Une clôture ajourée déroge au délai.|",
    "27. Dérogations mineures|\n\nSelon l'art. 8.11.9.9, al. 44, la marge est d'au moins 29,2 m.| La Cie Brabilot inc. occupe le rez-de-chaussée.|",
    "Qui peut signer ?| Sont prohibés : a) les enseignes; b) les bannières de plus de 24,5 m; c) les structures.| Le muret... n'a jamais été réparé.|",
    "Sont exigés au dépôt :\na) un plan à jour;\nb) une coupe de 23,7 m;\nc) un relevé, une photo, etc.|",
    "Le panneau porte la mention « Accès interdit. » et reste visible.| L'urbaniste répond : « Oui, mais à une seule condition. »| Le conseil a-t-il reçu l'avis ?| Non.| Le comité vote.|",
    "« Est-ce permis ? » demande le requérant au comptoir.| (Voir aussi le croquis du lot 398.)| Mme Vaunichel et le Dr Cousignac demeurent ici.|",
    'The sign reads "Keep out." and must stay legible.| "Is a permit required?" the owner asked.| The office closes at 4 p.m. on weekdays.|',
    "Die Sitzung fand am 3. Oktober 2003 statt.| Kleine Bauten, z. B. Schuppen, sind erlaubt.| „Brauche ich eine Genehmigung?“, fragte die Eigentümerin.|",
    "Мелкие постройки, т. е. сараи, допускаются.| Кто подписывает заявку?| Комиссия соблюдает границу участка.|",
    "¿Quién firma la solicitud?| ¡Prohibido rellenar la orilla!| La piscina exterior se rige por el plazo de 61 días.|",
    "4. 围栏与挡土墙|\n\n委员会说：“可以，但是有一个条件。”然后结束了会议。|“需要许可证吗？”业主在窗口问。|河岸禁止填土！|",
    "看板には「立入禁止。」と書かれている。|塀の高さは8.7メートルを超えてはならない。|",
    "डॉ. Chasidré ने योजना क्र. 323 पर हस्ताक्षर किए।| आवेदक धारा 59 का पालन करेगा।|",
    "يمنع الردم على ضفة النهر!| سأل المالك: «هل أحتاج إلى رخصة؟» ثم غادر المكتب.| عرض القطعة 26.6 م وعمقها 10.2 م.|",
    "รั้วต้องสูงไม่เกิน 63 เมตรตลอดแนว| คณะกรรมการพิจารณาแผนผังของเขต|\n\nรั้วและกำแพง|",
    "Mieszka przy ul. żółtej od lat.| Dom stoi dalej, ul. źródlana też.| Koniec.|",
    "Bydlí v čtvrti, str. čtvrtá platí.| Ředitel odešel.|",
    "Δες σελ. δύο του σχεδίου.| Ποιος υπογράφει;| Έτσι τελειώνει.|",
    "ផ្ទះនេះធំ។| ផ្លូវនេះវែង។|",
    "ဒီအိမ်ကကြီးတယ်၊ လှတယ်။| လမ်းကရှည်တယ်။|",
    "ቤቱ ትልቅ ነው።| መንገዱ ረጅም ነው።|",
    "Տունը մեծ է։| Ճանապարհը երկար է։|",
    "ཁང་པ་ཆེན་པོ་རེད། །| ལམ་རིང་པོ་རེད།|",
    "बाड़ की ऊँचाई कम है।| ঘরটি বড়।| பெரிய வீடு. சாலை நீளமானது.|".replace(". சா", ".| சா"),
    "Die Sitzung war am 7. Oktober 2004 im Haus.| Der Antrag vom 9. Oktober liegt vor.| Es gilt Artikel 12.| Der Rat tagt.|",
    "Une largeur d'au moins 25,5 mètres\nen bordure de la route 9.| 73 jours suffisent\npour corriger la demande.|Le réseau est prêt.|",
]


def expected(marked):
    text, ends = "", []
    for part in marked.split("|"):
        text += part
        ends.append(len(text))
    out, start = [], 0
    for end in ends[:-1]:
        while text[start].isspace():
            start += 1
        out.append((start, end))
        start = end
    return text, out


@pytest.fixture(scope="module")
def found(spark):
    rows = [(i, expected(c)[0]) for i, c in enumerate(CASES)]
    # A corpus in which the abbreviations, names and first words of the cases also stand elsewhere.
    filler = ["Voir l'art. 5 et l'al. 6. La zone est là, au sud. Une fois. Les lots. Selon le plan, la Cie Xavit inc. est ici.", "M. Plaval et le Dr Xanic, ing., ont mme parlé. La rue Cousignac.", "Le comité et le muret. Mme Zed vient. Mme Qed part. Le conseil."] * 3
    rows += [(100 + i, t) for i, t in enumerate(filler)]
    df = spark.createDataFrame([(i, t, 7) for i, t in rows], "doc_id bigint, text string, end_pos int")
    out = {}
    for r in split_sentences(df).collect():
        out.setdefault(r["doc_id"], []).append((r["start_pos"], r["end_pos"]))
    return {k: sorted(v) for k, v in out.items()}


@pytest.mark.parametrize("k", range(len(CASES)))
def test_case(found, k):
    text, want = expected(CASES[k])
    assert [text[a:b] for a, b in found[k]] == [text[a:b] for a, b in want]


def test_edges(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, " \n\n "), (None, "A. B."), (4, "x" * 200_000), (5, "..."), (6, "  Fin.  ")], "doc_id bigint, text string")
    got = sorted((r["doc_id"], r["start_pos"], r["end_pos"]) for r in split_sentences(df).collect())
    assert got == [(4, 0, 200_000), (5, 0, 3), (6, 2, 6)]
    assert split_sentences(df.limit(0)).count() == 0
    odd = [(k, x) for k, x in enumerate(["(" * 50_000 + "]" * 50_000, '"a. ' * 20_000, " " * 100_000 + "a", "\n" * 100_000, "a." * 50_000, "« a. » " * 20_000, "1. " * 30_000])]
    assert split_sentences(spark.createDataFrame(odd, "doc_id bigint, text string")).count() > 0
    kept = split_sentences(df.where("doc_id = 6"), keep_text=True).collect()
    assert [r["sentence"] for r in kept] == ["Fin."]


def test_repeated_rows_and_ids(spark):
    rows = [(1, "Un mot. Deux mots."), (1, "Un mot. Deux mots."), (1, "Trois."), (1, None)]
    got = sorted((r["start_pos"], r["end_pos"]) for r in split_sentences(spark.createDataFrame(rows, "doc_id bigint, text string")).collect())
    assert got == [(0, 6), (0, 7), (8, 18)]


def test_spans_do_not_overlap_and_cover_all_but_white_space(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    by = {}
    for r in split_sentences(docs).collect():
        by.setdefault(r["doc_id"], []).append((r["start_pos"], r["end_pos"]))
    for d, text in texts.items():
        at = 0
        for a, b in sorted(by.get(d, [])):
            assert a >= at and b > a and not text[at:a].strip() and text[a:b] == text[a:b].strip()
            at = b
        assert not text[at:].strip()


@pytest.mark.parametrize("loose", [5, 19, 20, 21, 30, 1000])
def test_loose_brackets_change_nothing(loose):
    text = "( " * loose + "Il dit « Non. » et part. Une autre fin."
    assert ends(text)[-2:] == [text.index(" Une"), len(text)]
    assert len(ends("« " + "( " * loose + "Non. » et part. Fin.")) == 2


def ends(text):
    return [m >> 31 for m in Reader(text, Tally()).read()[1]]


@pytest.mark.parametrize("indent", [0, 8, 12, 13, 200])
def test_list_numbers_stay_with_their_sentence(indent):
    text = "Sont exigés;\n" + " " * indent + "12. Un plan.\n\nFin."
    assert ends(text) == [text.index("\n\nFin"), len(text)]


@pytest.mark.parametrize("letters", [3, 39, 40, 41, 500])
def test_tokens_are_read_whole(letters):
    text = f"Un 1{'x' * letters}. Deux."
    tally = Tally()
    Reader(text, tally).read()
    assert (f"1{'x' * letters}", "deux") in tally.after


def test_long_texts_take_linear_time():
    for unit in ("Aa.", "A.", "a. ", '"a. ', "( a. ", "« a. ", "1. ", ";\n1. ", ".", "Aa. (", "x.-"):
        took = []
        for n in (5_000, 40_000):
            t = time.process_time()
            Reader(unit * n, Tally()).read()
            took.append(time.process_time() - t)
        assert took[1] < 24 * took[0] + 0.2, unit
