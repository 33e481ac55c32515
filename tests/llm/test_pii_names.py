import pytest

from gradeloom.llm.pii import Finder, redact

WORKS = frozenset("kirik pencere kumru kuzeyli halveti zulal".split())


@pytest.mark.parametrize(
    "text, want",
    [
        ("Adım Pınar.", ["Pınar"]),
        ("Adım Xelqan.", ["Xelqan"]),
        ("Dün Pınar Hanım geldi.", ["Pınar"]),
        ("Dün Xelqan Hanım geldi.", ["Xelqan"]),
        ("Sınıf arkadaşım Sibel sordu.", ["Sibel"]),
        ("Sınıf arkadaşım Xelqan sordu.", ["Xelqan"]),
        ("Seda Yılmaz 0532 123 45 67", ["Seda Yılmaz"]),
        ("Xelqan Zorbay 0532 123 45 67", ["Xelqan Zorbay"]),
        ("Derste Bülent, Yunus ve Hilal konuştu.", ["Bülent", "Yunus", "Hilal"]),
        ("Arkadaşım Türkçe dersini sever. Babam Ankara'da. Annem geldi.", []),
        ("Merhaba hocam. Küçük Hanım bekledi. Sayın Hocam, Zülal Hanım kim?", []),
        ("Telefonum 0532 123 45 67. Cep Telefonu: 0532 123 45 67", []),
        ("ÖRNEĞİN, TANIDIK SEVİNÇ SON DİZEDE. BABAM OKULA GİTTİ.", []),
    ],
)
def test_names_of_any_letter(text, want):
    assert [text[s:e] for k, s, e in Finder(WORKS).find(text) if k == "person_name"] == want


def test_redaction_takes_the_name_out():
    t = "Adım Pınar, öğretmenim Seda Hanım."
    assert redact(t, Finder().find(t)) == "Adım [PERSON_NAME], öğretmenim [PERSON_NAME] Hanım."


def test_ways_are_streets():
    find = lambda t: [t[s:e] for k, s, e in Finder().find(t) if k == "street_address"]
    assert find("Evimiz Bağdat Yolu No: 12 orada.") == ["Bağdat Yolu No: 12"]
    assert find("Evimiz Bağdat Yolu 12 adresinde.") == ["Bağdat Yolu 12"]
    assert find("Okul yolu 15 dakika sürer. İpek Yolu 2000 yıllıktır. Köy yolu 3 km.") == []
