import pytest
from pyspark.sql import functions as F

from gradeloom.llm.pii import Finder, find_pii, redact, redact_texts

from ..factory import frame, record

WORKS = frozenset("kirik pencere kumru kuzeyli halveti zulal".split())


def found(text):
    return [(k, text[s:e]) for k, s, e in Finder(WORKS).find(text)]


@pytest.mark.parametrize(
    "text, want",
    [
        ("Bana ali.veli@okul.example adresinden yaz.", [("email", "ali.veli@okul.example")]),
        ("yaz: ali [at] x", []),
        ("yaz: ali[at]okul[nokta]example tamam", [("email", "ali[at]okul[nokta]example")]),
        ("yaz: ali-veli et okul nokta example nokta com ya da", [("email", "ali-veli et okul nokta example nokta com")]),
        ("Metinde @ işareti var.", []),
        ("Tel: (0532) 123-45-67 ara", [("phone", "(0532) 123-45-67")]),
        ("Velim (0532 123 45 67) imzaladı", [("phone", "0532 123 45 67")]),
        ("Tel: +90 532 123 45 67", [("phone", "+90 532 123 45 67")]),
        ("Tel: 00905321234567", [("phone", "00905321234567")]),
        ("ara: 532.123.45.67.", [("phone", "532.123.45.67")]),
        ("Tel: sıfır beş yüz otuz iki yüz yirmi üç kırk beş altmış yedi", [("phone", "sıfır beş yüz otuz iki yüz yirmi üç kırk beş altmış yedi")]),
        ("Kitabın barkodu 00593464540 diye basılmış.", []),
        ("ISBN 978-60-722496761 gibi bir sayı.", []),
        ("T.C. kimlik no: 341 300 316 27", [("identity_number", "341 300 316 27")]),
        ("TCKN=12345678901; no=2025-9691", [("identity_number", "12345678901"), ("identity_number", "2025-9691")]),
        ("Kimlik no yazmayı unuttum.", []),
        ("Numaram 686/15, şubem B.", [("identity_number", "686/15")]),
        ("Ben 10C750 numaralı öğrenciyim.", [("identity_number", "10C750")]),
        ("Sorunun kodu 2025-0017, süresi 57 dakika.", []),
        ("Evimiz İncirlik Dibi Mahallesi Şafakören Caddesi No 61 Daire 8, orada.", [("street_address", "İncirlik Dibi Mahallesi Şafakören Caddesi No 61 Daire 8")]),
        ("Biz GÖKÇEBAĞ MH. ÜNLÜTEPE CD. NO:54 adresinde", [("street_address", "GÖKÇEBAĞ MH. ÜNLÜTEPE CD. NO:54")]),
        ("Dar bir sokak çizilmişti. Cadde boyunca 29 ev sayılıyor.", []),
        ("Komşumuz Elif Hanım anlatırdı.", [("person_name", "Elif")]),
        ("İmza: Tarık KUZŞAVKIRAN", [("person_name", "Tarık KUZŞAVKIRAN")]),
        ("Öğretmenimiz Taşbilekçi, Yasemin derste söyledi.", [("person_name", "Taşbilekçi, Yasemin")]),
        ("Zülal bahçede Halveti ile karşılaşır. Kumru Kuzeyli bu metinde anlatır.", []),
        ("Umut büyür, deniz susar. Adım adım okuyunca anlam değişir.", []),
        ("", []),
    ],
)
def test_cases(text, want):
    assert found(text) == want


def test_name_inside_mail_is_no_case():
    assert [k for k, _ in found("e-postam yasemin.tan@okul.example, tamam")] == ["email"]


def test_redaction():
    t = "Adım Elif Kaya, tel 0532 123 45 67."
    assert redact(t, Finder().find(t)) == "Adım [PERSON_NAME], tel [PHONE]."


def test_frames(spark):
    works = spark.createDataFrame([("Kırık Pencere", "Kumru Kuzeyli", ["Zülal", None]), (None, None, None)], "title string, author_name string, characters array<string>")
    long = "x " * 200_000 + "Tel: 0532 123 45 67"
    rows = [record(1, student_response__text="Komşumuz Elif Hanım", task__context="Tel: 0532 123 45 67"), record(1, student_response__text=None, task__context=""), record(2, student_response__text=long)]
    df = frame(spark, rows).withColumn("field", F.col("id")).withColumn("t", F.col("id"))
    got = sorted(tuple(r)[:4] for r in find_pii(df, works).collect())
    assert got == [(1, "student_response.text", "person_name", 9), (1, "task.context", "phone", 5), (2, "student_response.text", "phone", 400_005)]
    assert find_pii(df.limit(0), works.limit(0)).count() == 0
    red = {(r.record_key, r.field): r.text for r in redact_texts(df, works).where("record_key = 1").collect()}
    assert red[1, "student_response.text"] == "Komşumuz [PERSON_NAME] Hanım"
