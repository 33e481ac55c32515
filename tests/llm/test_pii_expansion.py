import time

import pytest

from gradeloom.llm.pii import FIRST_NAMES, Finder, fold

# no first name here is a listed one
NAMES = "Rüzgar Poyraz Toros Atlas Doruk Tuğra Kuzey Aras Çınar Güney Alperen Bora Yiğithan Umay Lina Defnesu Alya Nehirsu Mavi Liya Arven Göktuğhan Ilgaz Ulukan Sarp Aybars Tibet Kıvanç Ulaşcan Esila Mira Nefes".split()
NAMES = [n for n in NAMES if fold(n) not in FIRST_NAMES]
SURNAMES = "Aydınlıoğlu Korkmazer Demirkol Akbulut Çelebioğlu Taştan Gökdemir Uzunova".split()
FORMS = [
    ("Adım {n}.", "{n}"),
    ("Arkadaşım {n} geldi.", "{n}"),
    ("Dün {n} Hanım aradı.", "{n}"),
    ("Metni bana {n} {s} verdi.", "{n} {s}"),
    ("Bence en çok {n} {s} ile konuştu.", "{n} {s}"),
    ("Yazan: {n} {s}", "{n} {s}"),
    ("Kayıt için {n} {s} 0532 111 22 33 aranır.", "{n} {s}"),
    ("Öğretmenim Sn. {n} {s} söyledi.", "{n} {s}"),
]


def found(text, kind):
    return [text[a:b] for k, a, b in Finder().find(text) if k == kind]


def test_names_that_no_list_has():
    assert len(NAMES) >= 25
    hit = total = 0
    for i, n in enumerate(NAMES):
        for form, want in FORMS:
            s = SURNAMES[i % len(SURNAMES)]
            hit += want.format(n=n, s=s) in found(form.format(n=n, s=s), "person_name")
            total += 1
    assert hit / total >= 0.9


@pytest.mark.parametrize("text", ["Dün Ege Denizi maviydi.", "Bizim Boğaziçi Köprüsü uzundur.", "Biz Yıldız Lisesi öğrencisiyiz.", "Orada Kızıl Elma vardı, o kızıl elma güzeldi."])
def test_capitals_that_are_no_person(text):
    assert found(text, "person_name") == []


@pytest.mark.parametrize(
    "text, kind, want",
    [
        ("Karşıda Atatürk Bulvarı 15 var.", "street_address", "Atatürk Bulvarı 15"),
        ("Ara: +1 212 555 0199 hemen", "phone", "+1 212 555 0199"),
        ("Tel +49 30 1234567.", "phone", "+49 30 1234567"),
        ("Numara 0049 30 1234567 idi.", "phone", "0049 30 1234567"),
        ("Adres Lindenstraße 12, Berlin", "street_address", "Lindenstraße 12"),
        ("Lange Str. 5", "street_address", "Lange Str. 5"),
        ("He lives at 12 Baker Street now.", "street_address", "12 Baker Street"),
        ("T.C. kimlik numaram, annemin bana dün akşam yemekte uzun uzun anlattığı ve benim de buraya yazdığım 12345678901 olur", "identity_number", "12345678901"),
    ],
)
def test_expansion(text, kind, want):
    assert found(text, kind) == [want]


def test_time_grows_with_the_text():
    def seconds(n):
        t = "Dün Tarkan Yıldız geldi, adresi Gül Sokak 5 ve 0532 111 22 33. " * n
        at = time.process_time()
        Finder().find(t)
        return time.process_time() - at

    seconds(100)
    assert seconds(3200) < 16 * seconds(400) + 0.2
