"""Personal information in free text, found by anchor expansion.

An Aho-Corasick automaton runs once over the folded text (small letters, no Turkish
diacritics, same length) and finds anchors: at-signs and their spellings, digits and
signs that can open a number, spelled-out digits, words that announce an identifier, a
street or a name, and common first names (a prior: elsewhere two capitalised words inside a
sentence that the text never writes small are a name and surname).  Each anchor is expanded by a deterministic
local parser that validates the format and settles where the value starts and ends.
Mentions of literary works, their authors and characters are no cases.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import spread

FIELDS = ("student_response.text", "task.context")
FOUND_SCHEMA = "record_key bigint, field string, pii_type string, start_char int, end_char int"
MAX_WORKS = 100_000

# Common first names (folded), used as anchors only.
FIRST_NAMES = frozenset(
    "ahmet mehmet mustafa ali huseyin hasan ibrahim ismail osman yusuf murat omer ramazan halil suleyman abdullah mahmut recep salih fatih "
    "kadir emre hakan kemal yasar metin serkan orhan burak furkan arif cengiz tolga onur kerem cihan tarik ilker baran cagri orhun volkan "
    "sinan selim erdem ozan okan tuncay cem can kaan mert eren efe arda berk alp alper barbaros bora caner deniz dogan ege ekrem enes engin "
    "ercan erhan erkan ersin ferhat fikret gokhan gurkan haluk harun ilhan kamil koray levent melih nihat nuri oguz oktay polat rasim riza "
    "sami sedat semih serdar serhat sezer taner tamer tayfun timur tufan ugur umit umut veli vedat yavuz yigit zafer zeki "
    "fatma ayse emine hatice zeynep elif meryem serife sultan hanife merve havva zehra esra fadime ozlem hacer yasemin melek rabia hulya "
    "cemile sevim gulsum leyla dilek busra aysel songul kubra halime esma aynur kader sevgi hayriye tugba sevda nermin selin defne melis "
    "sule gizem ayca omur asli aslihan ayla aylin basak bahar banu belgin berna beste betul burcu canan ceren cigdem damla derya didem "
    "duygu ebru ece eda ela esin evrim ezgi feride filiz funda gamze gonca gul gulay gulcan hande hale ilknur ipek irem jale "
    "kader kamile keziban kivilcim lale lamia lerzan lutfiye mehtap mebrure medine mediha melahat melda melike melisa meltem meral mihriban mine "
    "miray muazzez mualla mujde mukaddes munevver muge mujgan mutlu muzeyyen nagihan nazan nazife nazli nazlican nebahat necla nehir neriman nermin nesibe neslihan nesrin "
    "nevin nezihe nigar nihal nihan nil nilay nilgun nilufer nisa nur nuran nuray nurcan nurdan nurgul nurhan nursel nurten oya oznur ozge ozgul pelin pelinsu perihan "
    "pervin petek pinar rana refika reyhan ruya ruveyda saadet sabiha sabriye sadiye safiye saime saliha sanem seda sedef seher selda selma semiha semra sena serap serpil seval sevgul "
    "sevil sevilay sevinc seyma sibel sidika simge sinem sirin solmaz sude sudenaz suheyla suna sukran sukriye sumeyye suzan sahika sehnaz sebnem sermin simal tuba tulay tulin turkan "
    "ulku umran umran ummuhan vildan yagmur yaprak yaren yeliz yesim yildiz yonca zahide zeliha zekiye zerrin zisan zubeyde zuhal zuleyha zumra asya azra beren berra ceyda ceylin ceren cansu "
    "dilara dilan dilay ecrin elanur eylul feyza gulsah gulsen gulten gunes handan hatun hazal hilal hira hicran huriye ikbal ilayda inci kardelen kezban miray naz oyku perin ravza sila tuana tugce zeren "
    "adem adnan akin alaattin alican alparslan altan anil asim atakan atilla aydin aykut aytac aziz bahadir bahattin batuhan bayram bedirhan behcet bekir berat berkan berkay besim bilal bilgin birol bulent "
    "bunyamin burhan cafer cahit caglar cavit celal celalettin cemal cemil cenk cetin cevat cevdet cihat coskun cumali davut dursun ecevit efekan emin emirhan emir emrah ender ensar ercument erdal erdinc erdogan "
    "erhan erol ertan ertugrul esat eyup ethem fahri faruk fazil ferdi ferit fevzi feyyaz firat fuat galip gazi giray goktug gultekin gunay gurbuz gursel habib haci hakki haldun halit hamdi hamit hamza harun hasim hayati "
    "hayri hidayet hikmet hilmi hudai hulusi husnu idris ihsan ilyas irfan isa ishak ismet izzet kaya kazim kenan kerim kubilay kutay lutfi mahir mazhar mecit mehdi memduh mesut mevlut mikail miran mithat muammer muaz muhammed muhammet muharrem "
    "muhittin muhsin mujdat mumin munir musa muslum mustakim muzaffer nadir nail namik nazim necati necip necmettin nedim nejat nevzat niyazi nizamettin numan nurettin nurullah oguzhan olcay onder onur orcun ozcan ozgur ozkan raif raif ramiz rauf "
    "refik remzi resat resit ridvan rifat rustem ruhi rustu sabahattin sabri sadettin sadik saffet saim sait salim samet samim satilmis sebahattin sefa sefer selahattin selami selcuk serdal serkut seyfettin seyfi sezai sezgin sirri sitki sinasi sukru suat "
    "sakir saban sahin serafettin seref sevket taha tahir tahsin talat talha tanju tarkan tayyar tekin temel teoman tevfik tugrul tuna tunc turan turgay turgut turhan ufuk ulas utku vahap vahit vural yakup yalcin yasin yekta yildirim yilmaz yunus yuksel "
    "zeynel zihni ziya zulfu".split()
)
#: of these, the ones that are also everyday words: a capital alone says nothing
EVERYDAY = frozenset("umut deniz bahar sevgi sevda damla derya ege ozlem can cem mert gul ipek sultan basak duygu evrim onur zafer yigit tufan yavuz dilek melek omur cagri defne eda ela gonca hale cigdem eren kadir yasar sevim ilhan polat dogan alp efe arda metin engin erdem "
    "kader lale mutlu nazli nehir nil nur pinar petek reyhan ruya saadet sedef seher serap sevinc sirin simge suna yagmur yaprak yildiz yonca gunes hilal inci kardelen naz oyku sila eylul mine mehtap meltem nihan sena hatun "
    "akin aydin aziz bayram bilgin coskun dursun emin emir gazi haci hidayet hikmet galip kaya kerim mecit mahir mumin nadir nail onder ozgur rauf sadik saffet sefer selami serap seref sezgin sahin sabit temel tuna tunc turan ufuk ulku ulas utku yalcin yildirim yilmaz yuksel zihni ziya firat cetin davut "
    "satilmis tekin petek tahir erdogan ecevit yunus miran asya isa musa muhammed hira medine habib izzet ender yakup hamdi hulusi celal cemal sitki sirri ihsan irfan ismet".split())
#: announce a name
NAME_BEFORE = ("adim", "ismim", "adi", "ben", "imza", "hazirlayan", "yazan", "ogretmenim", "ogretmenimiz", "ogretmeni", "hocamiz", "arkadasim", "arkadasimiz", "oturan", "komsumuz", "komsum", "agabeyim", "abim", "ablam", "kardesim", "kuzenim", "annem", "babam", "dedem", "teyzem", "halam", "amcam", "dayim", "velim", "velisi", "ustunde", "kisi", "kosesine", "grup", "odevi", "sayin", "sn", "bay", "bayan", "ogrencim", "mudurumuz")
#: announce a name so clearly that it need not be a known one
STRONG_BEFORE = frozenset("adim ismim imza hazirlayan oturan velim ustunde kisi kosesine grup ben arkadasim ogretmenim ogretmenimiz".split())
#: announce a person, so that any capitalised word after them is a name
NAMING = STRONG_BEFORE - {"ben", "ustunde", "kisi", "kosesine", "grup"} | frozenset("ogretmeni hocamiz arkadasimiz komsumuz komsum agabeyim abim ablam kardesim kuzenim annem babam dedem teyzem halam amcam dayim velisi sayin sn bay bayan ogrencim mudurumuz".split())
#: follow a name
NAME_AFTER = frozenset("hanim bey hanimefendi beyefendi hoca hocam ogretmen teyze amca abla abi".split())
#: of these, the ones that follow no other capitalised word than a name or a calling
ADDRESS_AFTER = frozenset("hanim bey hanimefendi beyefendi hoca".split())
#: capitalised without being a name of a person, where a name is expected
NO_PERSON = frozenset(
    "turkce turk turkiye ingilizce almanca fransizca arapca edebiyat matematik tarih cografya fizik kimya biyoloji felsefe fen din resim muzik beden rehberlik sinif mudur mudire muavin doktor avukat hakim komutan pasa "
    "ankara istanbul izmir bursa antalya adana konya trabzon almanya avrupa anadolu allah tanri ataturk pazartesi sali carsamba persembe cuma cumartesi pazar ocak subat mart nisan mayis haziran temmuz agustos eylul ekim kasim aralik "
    "sayin sevgili degerli kiymetli saygideger merhaba selam evet hayir peki tamam tesekkurler lutfen canim sizin senin onun onlar siz sen biri bir her hicbir kimi bazi butun tum hangi nasil neden niye eger ama fakat ancak cunku yani sonra once simdi bugun dun yarin "
    "kucuk buyuk genc yasli yeni eski guzel iyi kotu ilk son diger baska oteki ayni boyle soyle gercek zengin fakir komsu yabanci beyaz kara metin metinde metnin hikaye hikayede siir siirde roman romanda yazar sair anlatici kahraman karakter soru cevap yanit odev sinav "
    "adim ismim telefon telefonum telefonu telefonumuz numara numaram numarasi cep gsm ara arayin iletisim faks fax veli velim ev is tel email eposta posta mail kayit imza tarih yer sube".split()
)
#: what two capitalised words before it are the name of, if not of a person
NO_PERSON_AFTER = frozenset("lisesi ortaokulu ilkokulu okulu koleji universitesi fakultesi kurumu dernegi vakfi partisi gazetesi dergisi yayinlari yayinevi kitabevi romani hikayesi siiri oyunu destani sokagi sokak caddesi cadde bulvari mahallesi koyu ilcesi ili sehri denizi golu nehri dagi koprusu kulesi camii parki muzesi tepesi adasi korfezi bogazi vadisi ovasi savasi donemi cumhuriyeti devleti imparatorlugu".split())
#: minutes, metres and the like after a number that is no house number
_UNIT = re.compile(r"\s*(?:['’]|(?:dakika|dk|saat|gun|hafta|ay|yil|yas|km|kilometre|metre|m|adim|kez|kere|defa|tane|kisi|bin|milyon|yuz|lira|tl|basamak)\w*\b)")
#: written with a capital at a sentence start but no part of a name or a street
NO_NAME = frozenset("biz bizim ben benim evimiz evim ev mektubu mektup adres adresi adresim adresimiz sonuc kargosunu zarfin ustunde kayitta konusan kisi ve ile de da bu su o tel telefon imza no mah mahallesi mahalle sok sokak sokagi cad cadde caddesi bulvar bulvari sk cd mh tc t c kimlik nufus numaram okul ogrenci grup adim hocam emin yine bence ayrica bana gore".split())
MAH = r"(?:mahallesi|mahalle|mah|mh)"
STREET = r"(?:sokagi|sokak|sok|sk|caddesi|cadde|cad|cd|bulvari|bulvar|blv|yolu|meydani|meydan)"
POSSESSED = frozenset("dibi onu alti ustu yolu basi arkasi ici yani".split())

#: anchors that must begin a word, and but for street words also end one
_WHOLE = frozenset(("name", "cue", "title", "street", "quarter", "spelled", "id", "no id"))
#: of these, the ones that need not end a word
_OPEN = frozenset(("street", "quarter", "id", "no id"))

_NUM_WORDS = {"sifir", "bir", "iki", "uc", "dort", "bes", "alti", "yedi", "sekiz", "dokuz", "on", "yirmi", "otuz", "kirk", "elli", "altmis", "yetmis", "seksen", "doksan", "yuz"}
_FOLD = {}
for _c in range(0x80, 0x250):
    import unicodedata as _u

    _b = _u.normalize("NFD", chr(_c))[0].lower()
    if len(_b) == 1:
        _FOLD[_c] = _b
_FOLD |= {ord("ı"): "i", ord("İ"): "i", ord("’"): "'", ord("‘"): "'"}
_FOLD |= {c: chr(c + 32) for c in range(65, 91)}

_TOKEN = re.compile(r"[^\W\d_]+")
#: Characters of a word between house number and street; longer ones are no street names.
_LONGEST_WORD = 40
_PHONE = re.compile(
    r"(?:(?P<cc>\+\s?90|0090|\+\s?\(90\))[ .\-/]*)?(?:(?P<par>\(\s?0?\s?[2-5]\d{2}\s?\))|(?P<zero>0)?[ .\-/]?(?P<area>[2-5]\d{2}))"
    r"(?P<s1>[ .\-/]{0,3})\d{3}(?P<s2>[ .\-]?)\d{2}(?P<s3>[ .\-]?)\d{2}(?![\w]|[.\-/]\d)"
)
_TC = re.compile(r"[1-9](?:[ .\-]?\d){10}(?![\w]|[.\-/]\d)")
_SCHOOL = re.compile(r"(?:\d{4}-\d{2,6}|\d{1,4}/\d{1,5}|\d{1,2}-?[a-z]-?\d{2,5}|\d{2,9})(?![\w]|[.\-/]\d)")
#: a number abroad: country code, then groups of digits, 8 to 15 in all
_ABROAD = re.compile(r"(?:\+|00)[ ]?[1-9]\d{0,2}(?:[ .\-/]?\(?\d{1,5}\)?){1,6}(?![\w]|[.\-/]\d)")
_STREET_ABROAD = re.compile(r"(?:straße|strasse|str\.|gasse|platz)\s+\d{1,4}(?:\s?[a-z]\b)?(?!\d)")
_HOUSE_BEFORE = re.compile(r"(?<!\d)\d{1,5}[a-z]?\s+(?:[^\W\d_]+\s+){1,3}$")
_LOCATIVE = re.compile(r"(?:da|de|ta|te|dan|den|tan|ten)$")
_SCHOOL_CUE = re.compile(r"(?:(?:okul|ogrenci|sinif)\s+(?:no|num\w*)|numaram|numarasi)\s*(?:[:=.]|olan|da)?\s*$")
_NO_CUE = re.compile(r"(?:^|[;,]\s*)no\s*[:=]\s*$")
_STREET_AT = re.compile(r"\b(?P<w>" + STREET + r")\b\.?\s*(?:(?:no|numara|kapi)\s*[:.]?\s*)?\d{1,4}(?!\d)")
_MAH_AT = re.compile(r"\b" + MAH + r"\b\.?,?\s+(?P<rest>(?:[^\W\d_]+\s+){1,3}?" + STREET + r"\b\.?\s*(?:(?:no|numara)\s*[:.]?\s*)?\d{1,4}(?!\d)|(?:no|numara)\s*[:.]?\s*\d{1,4})")
_ADDR_TAIL = re.compile(r"(?:\s*(?:/\s?\d+|-\s?[a-z]\b|,?\s*(?:numara|no)\b(?:\s*[:.]?\s*\d+)?|,?\s*(?:daire|kat|d|k)\s*[:.]?\s*\d+))*")
_LABEL = r"[a-z0-9](?:[a-z0-9\-]*[a-z0-9])?"
_DOMAINS = {
    "@": re.compile(rf"\s?({_LABEL}(?:\.{_LABEL})+)"),
    "at": re.compile(rf"\s?({_LABEL}(?:\s?(?:\.|\[nokta\]|\(nokta\)|\[dot\]|\(dot\))\s?{_LABEL})+)"),
    "et": re.compile(rf"({_LABEL}(?:\s(?:nokta|dot)\s{_LABEL})+)"),
}
_LOCAL = re.compile(r"[\w.+\-%]+$")
_BREAK = re.compile(r"[.!?\n]")
_TWO_CAPITALS = re.compile(r"(?<![^\W\d_])[A-ZÇĞİÖŞÜ][^\W\d_A-ZÇĞİÖŞÜ]+[ \xa0][A-ZÇĞİÖŞÜ][^\W\d_A-ZÇĞİÖŞÜ]+")


def fold(text: str) -> str:
    """Small letters without diacritics, code point by code point."""
    return text.translate(_FOLD)


def _automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    kinds: dict[str, str] = {}
    for k in ("@",):
        kinds[k] = "@"
    for k in ("[at]", "(at)", "{at}"):
        kinds[k] = "at"
    for k in (" et ", " at "):
        kinds[k] = "et"
    for k in "0123456789":
        kinds[k] = "digit"
    kinds["sifir bes"] = "spelled"
    for k in ("sok", "sk", "cad", "cd", "bulvar", "blv", "meydan", "yolu"):
        kinds[k] = "street"
    for k in ("mah", "mh"):
        kinds[k] = "quarter"
    for k in ("straße", "strasse", "str.", "gasse", "platz", "street", "road", "avenue", "lane"):
        kinds[k] = "abroad"
    for k in ("tckn", "kimlik", "nufus", "vatandaslik", "tc", "t.c", "t c"):
        kinds[k] = "id"
    for k in ("barkod", "isbn", "issn", "kargo", "takip", "siparis", "fatura", "iban", "hesap", "kodu", "olcek", "basim", "kayit"):
        kinds[k] = "no id"
    for k in NAME_AFTER:
        kinds[k] = "title"
    for k in NAME_BEFORE:
        kinds.setdefault(k, "cue")
    for k in FIRST_NAMES:
        kinds[k] = "name"
    for k, v in kinds.items():
        a.add_word(k, (v, len(k)))
    a.make_automaton()
    return a


class _Cases(list):
    """Cases found so far, with a mark on each character that one covers."""

    def __init__(self, size: int):
        super().__init__()
        self.covered = bytearray(size)

    def append(self, case: tuple[str, int, int]) -> None:
        super().append(case)
        self.covered[case[1] : case[2]] = b"\1" * (case[2] - case[1])

    def end(self, at: int) -> int:
        """End of the covered run at ``at``."""
        e = self.covered.find(0, at)
        return len(self.covered) if e < 0 else e


class _Cues:
    """The words before a number, back to the start of its clause, that say what it is or is not."""

    def __init__(self, low: str, anchors: dict[str, list[int]]):
        self.low = low
        self.yes, self.no = anchors.get("id", []), anchors.get("no id", [])
        # the stops of an abbreviated cue end no clause
        inner = {p + k for p in self.yes for k in range(5)}
        self.breaks = [m.start() for m in _BREAK.finditer(low) if m.start() not in inner] if self.yes or self.no else []

    def _since(self, places: list[int], at: int) -> bool:
        k = bisect_left(places, at)
        if not k:
            return False
        j = bisect_left(self.breaks, at)
        return not j or places[k - 1] > self.breaks[j - 1]

    def national(self, at: int) -> bool:
        return self._since(self.yes, at)

    def other(self, at: int) -> bool:
        """Is it said, within the four words before, that the number is something else?  A later cue for an
        identity number outweighs that."""
        if not self._since(self.no, at):
            return False
        since = at - self.no[bisect_left(self.no, at) - 1]
        if since > 4 * _LONGEST_WORD or len(self.low[at - since : at].split()) > 4:
            return False
        return not (self._since(self.yes, at) and self.yes[bisect_left(self.yes, at) - 1] > self.no[bisect_left(self.no, at) - 1])


class Finder:
    """Finds cases text by text; ``works`` are the folded words of works, authors and characters."""

    def __init__(self, works: frozenset[str] = frozenset()):
        self.works = works
        self.auto = _automaton()

    def find(self, text: str | None) -> list[tuple[str, int, int]]:
        """``(type, start, end)`` in text order, without overlaps."""
        if not text:
            return []
        low = fold(text)
        anchors: dict[str, list[int]] = {}
        size = len(low)
        for end, (kind, n) in self.auto.iter(low):
            at = end - n + 1
            if kind in _WHOLE and ((at and low[at - 1].isalpha()) or (kind not in _OPEN and end + 1 < size and low[end + 1].isalpha())):
                continue  # part of another word
            anchors.setdefault(kind, []).append(at)
        two = _TWO_CAPITALS.search(text) is not None
        if not anchors and not two:
            return []
        out = _Cases(size)
        for kind in ("@", "at", "et"):
            for s in anchors.get(kind, ()):
                self._email(low, kind, s, out)
        self._addresses(text, low, anchors, out)
        for s in anchors.get("spelled", ()):
            self._spelled(low, s, out)
        last = -1
        cues = _Cues(low, anchors) if "digit" in anchors else None
        for s in anchors.get("digit", ()):
            if s > last and (s == 0 or not low[s - 1].isdigit()):
                last = max(last, self._number(low, s, out, cues))
        if not anchors.keys().isdisjoint(("name", "cue", "title")) or two or any(k == "phone" for k, _, _ in out):
            self._names(text, low, out)
        return sorted(out, key=lambda x: (x[1], -x[2]))

    # ---- e-mail ---------------------------------------------------------------------
    def _email(self, low: str, kind: str, at: int, out: list) -> None:
        n = {"@": 1, "at": 4, "et": 4}[kind]
        m = _DOMAINS[kind].match(low, at + n)
        if not m:
            return
        left = low[:at] if kind != "et" else low[:at]
        if left.endswith(" "):
            left = left[:-1]
        loc = _LOCAL.search(left)
        if not loc:
            return
        s = loc.start()
        while s < loc.end() and low[s] in ".-%+":
            s += 1
        if s < loc.end():
            out.append(("email", s, m.end()))

    # ---- addresses ------------------------------------------------------------------
    def _street_start(self, text: str, low: str, at: int) -> int | None:
        """Start of the name that ends right before ``at``; nothing if there is none."""
        toks: list[tuple[int, int]] = []
        p = at
        while len(toks) < 4:
            q = p
            while q > 0 and low[q - 1] in " \t\n\xa0":
                q -= 1
            if q == p:
                break
            e = q
            while q > 0 and (low[q - 1].isalpha() or low[q - 1] in "'-"):
                q -= 1
            if q == e or low[q:e] in NO_NAME or "\n" in low[e:p]:
                break
            toks.append((q, e))
            p = q
            if p and low[p - 1] not in " \t\xa0":
                break
        if not toks:
            return None
        first = text[toks[0][0]]
        start = toks[0][0]
        for k in range(1, len(toks)):
            w = text[toks[k][0] : toks[k][1]]
            if first.isupper():
                if not w[0].isupper() or (text[toks[0][0] : toks[0][1]].isupper() and not w.isupper()):
                    break
            elif not (k == 1 and low[toks[0][0] : toks[0][1]] in POSSESSED):
                break
            start = toks[k][0]
            if k + 1 == len(toks) or not text[toks[k + 1][0]].isupper():
                # the word that opens the sentence says where: it is no part of the name
                opens = start == 0 or re.search(r"[.!?\n]\s*$", low[max(0, start - 4) : start])
                if opens and k > 0 and _LOCATIVE.search(low[toks[k][0] : toks[k][1]]) and len(low[toks[k][0] : toks[k][1]]) > 4:
                    start = toks[k - 1][0]
        return start

    def _addresses(self, text: str, low: str, anchors: dict[str, list[int]], out: _Cases) -> None:
        for kind, pat in (("quarter", _MAH_AT), ("street", _STREET_AT)):
            for at in anchors.get(kind, ()):
                if out.covered[at] or not (m := pat.match(low, at)):
                    continue
                s = self._street_start(text, low, at)
                if s is None:
                    continue
                if m.groupdict().get("w") == "yolu" and "no" not in low[m.end("w") : m.end()] and (not text[s].isupper() or text[m.start("w")].islower() or _UNIT.match(low, m.end())):
                    continue  # a way that takes 15 minutes
                out.append(("street_address", s, _ADDR_TAIL.match(low, m.end()).end()))
        for at in anchors.get("abroad", ()):
            if out.covered[at]:
                continue
            s = at
            while s and low[s - 1].isalpha():
                s -= 1
            m = _STREET_ABROAD.match(low, at)
            if m and text[s].isupper():
                if s == at:  # the name stands before it, as in Lange Str. 5
                    s = self._street_start(text, low, at)
                if s is not None:
                    out.append(("street_address", s, m.end()))
            elif s == at and text[at].isupper() and (e := _TOKEN.match(low, at).end()) and low[at:e] in ("street", "road", "avenue", "lane"):
                line = low.rfind("\n", 0, at) + 1
                h = _HOUSE_BEFORE.search(low, max(line, at - 4 * _LONGEST_WORD), at)
                if h and all(text[w.start()].isupper() for w in _TOKEN.finditer(text, h.start(), at)):
                    out.append(("street_address", h.start(), e))

    # ---- numbers --------------------------------------------------------------------
    def _spelled(self, low: str, at: int, out: list) -> None:
        if at and low[at - 1].isalnum():
            return
        end, n = at, 0
        for m in _TOKEN.finditer(low, at):
            if m.group() not in _NUM_WORDS or (n and low[end : m.start()].strip(" -")):
                break
            end, n = m.end(), n + 1
        if n >= 8:
            out.append(("phone", at, end))

    def _number(self, low: str, at: int, out: _Cases, cues: _Cues) -> int:
        """Try each number parser at a digit run; returns the last position consumed."""
        if out.covered[at]:
            return out.end(at) - 1
        # the word or two right before a number, which the parsers of school numbers and phones ask for
        before = low[max(0, at - 2 * _LONGEST_WORD) : at]
        if before and (before[-1].isalnum() or before[-1] in "_@#"):
            return at
        start = at
        if before[-1:] == "(":
            # a bracket opens the number only if it closes after the area code
            if re.match(r"0?\s?[2-5]\d{2}\s?\)", low[at : at + 8]):
                start = at - 1
        elif before[-1:] == "+":
            start = at - 1
        elif before[-2:] == "+ ":
            start = at - 2
        elif before[-1:] in ("-", ".", "/", ",") and before[-2:-1].isdigit():
            return at
        tc_cue, not_id = cues.national(at), cues.other(at)
        if low[start] == "+" or low.startswith("00", at):
            a = _ABROAD.match(low, start)
            if a and not re.match(r"(?:\+ ?|00)90", a.group()) and 8 <= sum(c.isdigit() for c in a.group()) - 2 * (low[start] != "+") <= 15 and not not_id:
                out.append(("phone", start, a.end()))
                return a.end() - 1
        m = _TC.match(low, at)
        if m and tc_cue and not not_id:
            out.append(("identity_number", at, m.end()))
            return m.end() - 1
        p = _PHONE.match(low, start)
        if p and not not_id and self._phone_ok(p, before):
            out.append(("phone", start, p.end()))
            return p.end() - 1
        if m and not not_id and m.group().isdigit() and not re.match(r"\w", low[m.end() : m.end() + 1]):
            out.append(("identity_number", at, m.end()))
            return m.end() - 1
        s = _SCHOOL.match(low, at)
        if s and (_SCHOOL_CUE.search(before) and not re.search(r"kimlik\s+num\w*\s*$", before) or _NO_CUE.search(before) or re.match(r"\s+(?:numarali|nolu|no'lu)\s+ogrenci", low[s.end() : s.end() + 24])):
            out.append(("identity_number", at, s.end()))
            return s.end() - 1
        run = re.match(r"\d+", low[at:])
        return at + run.end() - 1

    @staticmethod
    def _phone_ok(p: re.Match, before: str) -> bool:
        seps = [x for x in (p.group("s1"), p.group("s2"), p.group("s3")) if x.strip() or x]
        if p.group("cc") or p.group("par") or p.group("zero"):
            return True
        return len(seps) >= 2 or bool(re.search(r"(?:tel\w*|gsm|cep|ara\w*|iletisim)\W*$", before))

    # ---- names ----------------------------------------------------------------------
    def _names(self, text: str, low: str, out: _Cases) -> None:
        toks = [m.span() for m in _TOKEN.finditer(text) if not out.covered[m.start()]]
        if not toks:
            return
        word = [low[s:e] for s, e in toks]
        cap = [text[s].isupper() for s, _ in toks]
        gap = ["" if k == 0 else text[toks[k - 1][1] : toks[k][0]] for k in range(len(toks))]
        known = [w in FIRST_NAMES for w in word]
        small = {w for w, c in zip(word, cap) if not c}
        n = len(toks)
        phones = any(k == "phone" for k, _, _ in out)
        found: list[tuple[int, int]] = []

        def is_initial(k: int) -> bool:
            return 0 <= k < n and toks[k][1] - toks[k][0] == 1 and cap[k] and text[toks[k][1] : toks[k][1] + 1] == "."

        def namelike(k: int) -> bool:
            return k < n and cap[k] and len(word[k]) >= 3 and word[k] not in NO_NAME and word[k] not in NAME_AFTER and word[k] not in self.works

        def shouted(k: int) -> bool:
            return text[max(0, toks[k][0] - 60) : toks[k][1] + 60].isupper()

        def person(k: int) -> bool:
            """Can an unlisted word be a name, where something says that one stands here?"""
            return namelike(k) and word[k] not in NO_PERSON and word[k] not in NAME_BEFORE

        def announced(k: int, c: str) -> bool:
            """Is the unlisted word ``k`` a name because of the cue before it?"""
            if c not in NAMING or not person(k):
                return False
            named = c in ("adim", "ismim")
            if "\n" in gap[k] and not re.search("[:=]", gap[k]) or "," in gap[k] and not named:
                return False
            if shouted(k):
                return named and not re.match(r"\s*\w", text[toks[k][1] :])
            return True

        def titled(k: int) -> bool:
            """Does a title follow the unlisted word ``k``?"""
            if not person(k) or k + 1 >= n or gap[k + 1] not in (" ", "\xa0") or word[k + 1] not in NAME_AFTER or shouted(k):
                return False
            return word[k + 1] in ADDRESS_AFTER or not fresh(k)

        def called(k: int) -> int | None:
            """Last token of unlisted words from ``k`` on that a phone number follows."""
            e = k
            while phones and e < k + 3 and person(e):
                if self._followed_by_number(low, toks[e][1]):
                    return None if re.match(r"tel|num|gsm", word[e]) else e
                if e + 1 >= n or gap[e + 1] not in (" ", "\xa0"):
                    return None
                e += 1
            return None

        def paired(k: int) -> bool:
            """Are ``k`` and ``k + 1`` an unlisted name and surname inside a sentence?  Neither is written small here."""
            if k + 1 >= n or gap[k + 1] not in (" ", "\xa0") or (fresh(k) and not cue(k)) or not (person(k) and person(k + 1)) or word[k + 1] in NO_PERSON_AFTER or shouted(k):
                return False
            if not (text[toks[k][0] + 1 : toks[k][1]].islower() and text[toks[k + 1][0] + 1 : toks[k + 1][1]].islower()):
                return False
            if k and gap[k] in (" ", "\xa0") and cap[k - 1] and not fresh(k - 1):
                return False  # within a longer name of something
            after = word[k + 2] if k + 2 < n and gap[k + 2] in (" ", "\xa0") else ""
            return not (k + 2 < n and after and cap[k + 2]) and after not in NO_PERSON_AFTER and small.isdisjoint((word[k], word[k + 1]))

        def cue(k: int) -> str | None:
            """The word that announces a name starting at token ``k``."""
            if k == 0 or not re.fullmatch(r"\s*[:=]?\s*|\s*,\s*" + (r"|\.\s*" if word[k - 1] == "sn" else ""), gap[k]) or "\n\n" in gap[k]:
                return None
            w = word[k - 1]
            return w if w in NAME_BEFORE and (w != "ustunde" or k < 2 or word[k - 2] in ("zarfin", "kagidin", "defterin", "kapagin")) else None

        def fresh(k: int) -> bool:
            """Does token ``k`` begin a sentence or line?"""
            return k == 0 or bool(re.search(r"[.!?…:\n”\"]|^\s*$", gap[k].replace(" ", "") or "x")) and gap[k].strip() != ""

        k = 0
        while k < n:
            s = e = k
            c = cue(k)
            ok = False
            if is_initial(k):
                j = k
                while is_initial(j + 1) and gap[j + 1] in (". ", "."):
                    j += 1
                if namelike(j + 1) and gap[j + 1] in (". ", "."):
                    e = j + 1
                    ok = bool(c) or bool(found and re.fullmatch(r"\s*,\s*|\s+ve\s+", text[found[-1][1] : toks[k][0]]))
                    ok = ok or self._followed_by_number(low, toks[e][1])
            elif known[k] or (namelike(k) and k + 1 < n and known[k + 1] and gap[k + 1].strip() == "," and found and re.fullmatch(r"\s*,\s*", text[found[-1][1] : toks[k][0]])) or (c and (namelike(k) or (c in STRONG_BEFORE and k + 1 < n and known[k + 1]))):
                if known[k]:
                    e = k
                    while e + 1 < n and known[e + 1] and gap[e + 1].strip(" \xa0") == "" and "\n" not in gap[e + 1]:
                        e += 1
                    given = e
                    if e + 1 < n and gap[e + 1] in (" ", "\xa0") and word[e + 1] not in NO_NAME and word[e + 1] not in NAME_AFTER and word[e + 1] not in NO_PERSON_AFTER:
                        nxt_cap = namelike(e + 1)
                        joined = bool(found) and bool(re.fullmatch(r"\s*,\s*|\s+(?:ve|ile)\s+", text[found[-1][1] : toks[k][0]]))
                        if nxt_cap or (not cap[k] and len(word[e + 1]) >= 6 and (c or joined or self._followed_by_number(low, toks[e + 1][1]) or text[toks[e + 1][1] : toks[e + 1][1] + 1] == ",")):
                            e += 1
                    in_work = all(word[x] in self.works for x in range(k, given + 1))
                    title = e + 1 < n and word[e + 1] in NAME_AFTER and gap[e + 1] in (" ", "\xa0")
                    linked = bool(found) and bool(re.fullmatch(r"\s*,\s*|\s+(?:ve|ile)\s+", text[found[-1][1] : toks[k][0]]))
                    number = self._followed_by_number(low, toks[e][1])
                    surname = e > given and cap[k] and not (word[k] in EVERYDAY and e == k + 1 and shouted(k))  # all capitals make any two words look so
                    middle = cap[k] and word[k] not in EVERYDAY and not fresh(k) and not text[max(0, toks[k][0] - 60) : toks[e][1] + 60].isupper()
                    pair = k + 2 < n and word[k + 1] in ("ile", "ve") and known[k + 2] and cap[k]
                    ok = bool(c) or title or linked or number or surname or middle or pair
                    if in_work and not (e > given and (c or number or title)):
                        ok = False
                elif namelike(k):
                    # "Surname, First", or an unknown name after a clear announcement
                    if k + 1 < n and gap[k + 1].strip() == "," and known[k + 1]:
                        e = k + 1
                        while e + 1 < n and known[e + 1] and gap[e + 1] == " ":
                            e += 1
                        ok = True
                    elif c in STRONG_BEFORE and c != "ben" or announced(k, c):
                        while e + 1 < n and namelike(e + 1) and gap[e + 1] == " ":
                            e += 1
                        ok = c in STRONG_BEFORE and e > k or announced(k, c)
                elif c and known[k + 1]:
                    e = k + 1
                    ok = cap[k]
            if not ok and namelike(k) and k + 1 < n and gap[k + 1].strip() == "," and "\n" not in gap[k + 1] and known[k + 1] and cap[k + 1] and (fresh(k) or self._followed_by_number(low, toks[k + 1][1])):
                # "Surname, First" that nothing announces, followed by a number
                e = k + 1
                ok = self._followed_by_number(low, toks[e][1])
            if not ok and not known[k] and paired(k):
                e, ok = k + 1, True
            if not ok and not known[k] and titled(k):
                e, ok = k, True
            if not ok and not known[k] and (last := called(k)) is not None:
                e, ok = last, True
            if ok:
                found.append((toks[s][0], toks[e][1]))
                k = e + 1
            else:
                k += 1
        for s, e in found:
            out.append(("person_name", s, e))
            # a school number right after a name
            m = re.match(r"\s+", low[e:])
            if m and e + m.end() < len(low) and low[e + m.end()].isdigit():
                at = e + m.end()
                v = _SCHOOL.match(low, at)
                if v and len(v.group()) >= 3 and not out.covered[at] and re.match(r"\s*(?:yaz\w*|$|\n|[.,;])", low[v.end() : v.end() + 12]):
                    out.append(("identity_number", at, v.end()))

    @staticmethod
    def _followed_by_number(low: str, e: int) -> bool:
        m = re.match(r"\s*(?:[-–,:/(]\s*)?(?=[+(\d]|sifir bes)", low[e : e + 8] + low[e + 8 : e + 20])
        if not m:
            return False
        return bool(_PHONE.match(low, e + m.end()) or low.startswith("sifir bes", e + m.end()) or _PHONE.match(low, e + m.end() + 1))


def redact(text: str, cases: list[tuple[str, int, int]]) -> str:
    """The text with each case replaced by its type in brackets; nested cases fall under the outer one."""
    parts, at = [], 0
    for kind, s, e in cases:
        if s < at:
            continue
        parts += [text[at:s], f"[{kind.upper()}]"]
        at = e
    return "".join([*parts, text[at:]])


def works_lexicon(works: DataFrame) -> frozenset[str]:
    """Folded words of titles, authors and characters; the table must have at most ``MAX_WORKS`` rows."""
    rows = works.select("title", "author_name", "characters").limit(MAX_WORKS + 1).collect()
    if len(rows) > MAX_WORKS:
        raise ValueError(f"more than {MAX_WORKS} works")
    out = set()
    for r in rows:
        for t in (r["title"], r["author_name"], *(r["characters"] or [])):
            if t:
                out |= {m.group() for m in _TOKEN.finditer(fold(t))}
    return frozenset(out)


def _texts(records: DataFrame, key: str, fields: tuple[str, ...]) -> DataFrame:
    parts = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("t")) for f in fields])
    return records.select(F.col(key).cast("bigint").alias("record_key"), F.explode(parts).alias("x")).select("record_key", "x.field", "x.t").where(F.length("t") > 0)


def find_pii(records: DataFrame, works: DataFrame, key: str = "record_key", fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """``FOUND_SCHEMA``: one row for each occurrence, with code-point offsets.

    Null and empty texts give no row, repeated rows give theirs each, texts are read
    whole.  A name inside an e-mail or an address is no case of its own.  Narrow, no shuffle.
    """
    lexicon = records.sparkSession.sparkContext.broadcast(works_lexicon(works))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = Finder(lexicon.value)
        memo: dict[str, list] = {}
        for b in batches:
            memo.clear()  # contexts repeat within a batch
            cols: list[list] = [[], [], [], [], []]
            for k, name, t in zip(*(b.column(i).to_pylist() for i in range(3))):
                if t not in memo:
                    memo[t] = f.find(t)
                for kind, s, e in memo[t]:
                    for c, v in zip(cols, (k, name, kind, s, e)):
                        c.append(v)
            if cols[0]:
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1]), pa.array(cols[2]), pa.array(cols[3], pa.int32()), pa.array(cols[4], pa.int32())], ["record_key", "field", "pii_type", "start_char", "end_char"])

    return spread(_texts(records, key, fields)).mapInArrow(run, FOUND_SCHEMA)


def redact_texts(records: DataFrame, works: DataFrame, key: str = "record_key", fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """``(record_key, field, text, n_cases)``: each text with typed placeholders."""
    lexicon = records.sparkSession.sparkContext.broadcast(works_lexicon(works))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = Finder(lexicon.value)
        for b in batches:
            texts = b.column(2).to_pylist()
            cases = [f.find(t) for t in texts]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([redact(t, c) for t, c in zip(texts, cases)]), pa.array([len(c) for c in cases], pa.int32())], ["record_key", "field", "text", "n_cases"])

    return spread(_texts(records, key, fields)).mapInArrow(run, "record_key bigint, field string, text string, n_cases int")
