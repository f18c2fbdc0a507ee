"""Surrogates for personal data, with DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landrank.llm.common import attach, written

#: The key of the surrogates in tests and queries; production passes its own.
KEY = "surrogate-key"
#: Tries after which a surrogate may be longer than what it stands for, so that tries come to an end.
TRIES = 6

#: Titles before a name and marks behind one, by gender ("n": either).
TITLES = {
    "m": ["Mr", "Herr", "Herrn", "Señor", "Don", "Monsieur", "Sir", "Господин", "Κύριος", "السيد", "מר", "श्री"],
    "f": ["Mrs", "Ms", "Miss", "Frau", "Señora", "Señorita", "Doña", "Madame", "Mademoiselle", "Lady", "Госпожа", "Κυρία", "السيدة", "גברת", "श्रीमती"],
    "n": ["Dr", "Prof", "Doctor", "Professor"],
}
MARKS = {"m": ["先生"], "f": ["女士", "小姐"], "n": ["さん", "様", "氏", "씨", "님"]}
#: First names that take the place of others, by script and gender; they also tell gender and names without a title.
FIRST = {
    ("latin", "m"): ["Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Georg", "Hugo", "Ivan", "Jonas", "Karl", "Leo", "Max", "Nils", "Oskar", "Paul"],
    ("latin", "f"): ["Anna", "Berta", "Clara", "Dora", "Emma", "Flora", "Greta", "Hanna", "Ida", "Julia", "Katja", "Lena", "Mia", "Nora", "Olga", "Petra"],
    ("cyrillic", "m"): ["Антон", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Иван", "Кирилл", "Лев", "Максим", "Никита", "Олег", "Павел", "Роман", "Степан", "Юрий"],
    ("cyrillic", "f"): ["Анна", "Вера", "Галина", "Дарья", "Елена", "Жанна", "Зоя", "Ирина", "Ксения", "Лидия", "Мария", "Нина", "Ольга", "Полина", "Раиса", "София"],
    ("greek", "m"): ["Άρης", "Βασίλης", "Γιώργος", "Δημήτρης", "Ηλίας", "Θανάσης", "Κώστας", "Λευτέρης", "Μάνος", "Νίκος", "Πέτρος", "Ρένος", "Σπύρος", "Τάσος", "Φώτης", "Χρήστος"],
    ("greek", "f"): ["Άννα", "Βάσω", "Γεωργία", "Δήμητρα", "Ελένη", "Ζωή", "Ηρώ", "Ιωάννα", "Κατερίνα", "Λίνα", "Μαρία", "Νίκη", "Ξένια", "Όλγα", "Ράνια", "Σοφία"],
}
#: More first names that tell gender and names without a title.
KNOWN = {
    "m": ("John James Robert Michael William Richard Joseph Thomas Charles Daniel Matthew Mark Peter Andrew George Hans Jürgen Klaus Wolfgang Stefan "
          "Jean Pierre Michel Philippe Jacques Juan José Carlos Luis Miguel Javier Pedro Antonio Francisco Manuel Алексей Дмитрий Сергей Михаил").split(),
    "f": ("Mary Jane Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Nancy Margaret Lisa Emily Ursula Monika Renate Sabine Ingrid "
          "Marie Françoise Isabelle Sophie Camille María Carmen Isabel Lucía Pilar Elena Teresa Rosa Cristina Laura Наталья Татьяна Светлана Екатерина").split(),
}
#: Syllables of invented names, by script: starts and ends.
STARTS = {
    "latin": "Bar Cor Dal Fen Gar Hol Jan Kel Lin Mar Nor Per Ros Sten Tor Vol".split(),
    "cyrillic": "Бар Кор Дал Фен Гар Хол Ян Кел Лин Мар Нор Пер Рос Стен Тор Вол".split(),
    "greek": "Μπαρ Κορ Νταλ Φεν Γκαρ Χολ Γιαν Κελ Λιν Μαρ Νορ Περ Ροσ Στεν Τορ Βολ".split(),
    "arabic": "بار كور دال فين غار هول يان كيل لين مار نور بير روس ستين تور فول".split(),
    "hebrew": "בר קור דל פן גר הול ין קל לין מר נור פר רוס סטן תור וול".split(),
    "devanagari": "बर कोर दल फेन गर होल जन केल लिन मर नोर पेर रोस स्टेन तोर वोल".split(),
    "han": list("王李張劉陳楊黃趙吳周徐孫馬朱胡林"),
    "hangul": list("김이박최정강조윤장임한오서신권황"),
}
ENDS = {
    "latin": "ac bel den eck field gren holt ing kin lund mann nov rick son ten wood".split(),
    "cyrillic": "ак бель ден ек фил грен хольт ин кин лунд ман нов рик сон тен вуд".split(),
    "greek": "ακ μπελ ντεν εκ φιλντ γκρεν χολτ ινγκ κιν λουντ μαν νοβ ρικ σον τεν γουντ".split(),
    "arabic": "اك بيل دين يك فيل غرين هولت ين كين لوند مان نوف ريك سون تين وود".split(),
    "hebrew": "אק בל דן יק פיל גרן הולט ין קין לונד מן נוב ריק סון טן ווד".split(),
    "devanagari": "अक बेल देन एक फील ग्रेन होल्ट इन किन लुंड मन नोव रिक सन तेन वुड".split(),
    "han": list("明華文國建志偉東平安永成德光海山"),
    "hangul": list("민서준현우진영수지호성재동훈경태"),
}
SCRIPTS = {"cyrillic": "IsCyrillic", "greek": "IsGreek", "arabic": "IsArabic", "hebrew": "IsHebrew", "devanagari": "IsDevanagari", "han": "IsHan", "hangul": "IsHangul"}
#: Words that make an address of a name and a number, before or after it, and at the end of a word.
STREET_AFTER, STREET_BEFORE = "Street|St|Avenue|Ave|Road|Rd|Lane|Ln|Drive|Boulevard|Blvd|Court|Way", "[Rr]ue|[Aa]venue|[Bb]oulevard|[Cc]alle|[Aa]venida|[Pp]laza"
STREET_END = "straße|strasse|gasse|allee|platz|weg"

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_WORD = r"[\p{Lu}\p{IsArabic}\p{IsHebrew}\p{IsDevanagari}][\p{L}\p{M}'’-]+"
_ALL_TITLES = "|".join(x for ts in TITLES.values() for t in ts for x in dict.fromkeys((t, t.upper())))
_ALL_MARKS = "|".join(m for ms in MARKS.values() for m in ms)
_ALL_FIRST = "|".join(dict.fromkeys(x for names in (*FIRST.values(), *KNOWN.values()) for n in names for x in (n, n.upper())))
_BEGIN = r"(?<![\p{L}\p{N}])(?=[\p{Lu}\p{IsArabic}\p{IsHebrew}\p{IsDevanagari}])"
#: What is found, in the order in which a place is tried.
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@(?:[\p{L}\p{N}-]+\.)+\p{L}{2,}",
    "secret": r"(?<![0-9A-Za-z])(?:[0-9a-f]{32,}|[0-9A-F]{32,}|AKIA[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36,}|sk-[0-9A-Za-z]{20,})(?![0-9A-Za-z])",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}\d{2}(?: ?[0-9A-Z]{4}){3,7}(?: ?[0-9A-Z]{1,3})?(?![0-9A-Za-z])",
    "card": r"(?<![\d.,-])\d{4}([ -]?)\d{4}\2\d{4}\2\d{1,7}(?![\d-])",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "ip": rf"(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\.?\d)",
    "born": r"(?<=(?:[Bb]orn|[Gg]eboren|[Nn]ée?|[Nn]acid[oa]|DOB|[Dd]ate of birth)(?: on| am| le| el|:)? )(?:\d{4}[./-]\d{1,2}[./-]\d{1,2}|\d{1,2}[./-]\d{1,2}[./-]\d{4})(?!\d)",
    "phone": r"(?<![\d.(+-])(?:\+\d{1,3}[ .-]?)?(?:\(\d{1,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]\d{3,4}(?![\d-])|(?<![\d+])\+\d{8,15}(?!\d)"
             r"|(?<=(?:[Tt]el|[Pp]hone|[Cc]all|[Ff]ax|[Mm]obile)[.:]?[ :])\d{7,15}(?!\d)",
    "address": rf"(?<![\p{{L}}\p{{N}}])\d{{1,5}} (?:\p{{Lu}}\p{{L}}+ ){{1,2}}(?:{STREET_AFTER})(?!\p{{L}})|(?<![\p{{L}}\p{{N}}])\p{{Lu}}\p{{L}}+(?:{STREET_END}) \d{{1,4}}(?!\d)"
               rf"|(?<![\p{{L}}\p{{N}}])\d{{1,4}},? (?:{STREET_BEFORE}) (?:de |la |du |des ){{0,2}}\p{{Lu}}\p{{L}}+|(?<![\p{{L}}\p{{N}}])(?:{STREET_BEFORE}) (?:de |la |del ){{0,2}}\p{{Lu}}\p{{L}}+,? \d{{1,4}}(?!\d)",
    "name": rf"{_BEGIN}(?:{_ALL_TITLES})\.? {_WORD}(?: {_WORD}){{0,2}}|{_BEGIN}(?:{_ALL_FIRST})(?: \p{{Lu}}\.)? {_WORD}"
            rf"|\p{{IsHan}}{{1,3}}(?=\s?(?:{_ALL_MARKS}))|\p{{IsHangul}}{{2,4}}(?=\s?(?:{_ALL_MARKS}))",
}


def _any(pattern: str) -> str:
    """The patterns as one, with the back-reference of the card's separator counted anew."""
    return pattern.replace(r"([ -]?)\d{4}\2\d{4}\2", r"(?<sep>[ -]?)\d{4}\k<sep>\d{4}\k<sep>")


ANY = _any("|".join(f"(?:{p})" for p in PATTERNS.values()))
#: Most texts have none of these, and are passed over by a cheap look.
HINT = rf"[0-9@]|{_BEGIN}(?:{_ALL_TITLES}|{_ALL_FIRST})(?![\p{{L}}])|{_ALL_MARKS}"


def found_in(text: Column) -> Column:
    """All that the patterns find, in order."""
    none = F.expr("cast(array() as array<string>)")
    return F.coalesce(F.when(text.rlike(HINT), F.regexp_extract_all(text, F.lit(ANY), F.lit(0))), none)


def kind_of(raw: Column) -> Column:
    """The type of a match: the first pattern that takes all of it; a bare word is a surname."""
    out = None
    for kind, p in PATTERNS.items():
        # what a pattern asks of the text around is left out
        whole = _any(p).replace("(?<=(?:[Bb]orn|[Gg]eboren|[Nn]ée?|[Nn]acid[oa]|DOB|[Dd]ate of birth)(?: on| am| le| el|:)? )", "").replace(
            "(?<=(?:[Tt]el|[Pp]hone|[Cc]all|[Ff]ax|[Mm]obile)[.:]?[ :])", "").replace(rf"(?=\s?(?:{_ALL_MARKS}))", "")
        hit = raw.rlike(f"^(?:{whole})$")
        out = F.when(hit, kind) if out is None else out.when(hit, kind)
    return out.otherwise("name")


# -- names -----------------------------------------------------------------------------------------------------------

def title_of(raw: Column) -> Column:
    """The title in front with the space after it, or nothing."""
    return F.regexp_extract(raw, rf"^(?:{_ALL_TITLES})\.? ", 0)


def name_words(raw: Column) -> Column:
    """The words of a name without its title: first names, then the surname."""
    return F.split(F.substring(raw, F.length(title_of(raw)) + 1, F.length(raw)), " ")


def gender_of(raw: Column) -> Column:
    """"m", "f" or "n": what the title says, else what the first name is known for or ends in."""
    title = F.lower(F.regexp_replace(title_of(raw), r"[. ]", ""))
    first = F.lower(F.element_at(name_words(raw), 1))
    lows = lambda names: [n.lower() for n in names]
    male, female = (lows([*KNOWN[g], *(n for (_, h), ns in FIRST.items() if h == g for n in ns)]) for g in "mf")
    many = F.size(name_words(raw)) > 1
    return (F.when(title.isin(lows(TITLES["m"])), "m").when(title.isin(lows(TITLES["f"])), "f")
            .when(many & first.isin(male), "m").when(many & first.isin(female), "f")
            .when(many & first.rlike("[aαηая]$"), "f").when(many & first.rlike("ς$"), "m").otherwise("n"))


def script_of(word: Column) -> Column:
    out = None
    for script, block in SCRIPTS.items():
        hit = word.rlike(rf"\p{{{block}}}")
        out = F.when(hit, script) if out is None else out.when(hit, script)
    return out.otherwise("latin")


def parts_of(kind: Column, raw: Column) -> Column:
    """What a match is made of, as an array of (kind, sub, norm), each of which has a surrogate of its own.

    A name is its first names, by gender, and its surname, so that "Dr Jane Doe", "Ms Doe" and "Doe" stay one person.
    What refers to the same thing has the same normal form: letters and digits of numbers, lower case of the rest.
    """
    bare = F.lower(F.regexp_replace(raw, r"[^\p{L}\p{N}]", ""))
    groups = [F.regexp_extract(raw, r"^(\d+)[./-](\d+)[./-](\d+)$", k) for k in (1, 2, 3)]
    ahead = F.length(groups[0]) == 4
    date = F.try_to_timestamp(F.when(ahead, F.concat_ws("-", *groups)).otherwise(F.concat_ws("-", *groups[::-1])), F.lit("y-M-d")).cast("date").cast("string")
    norm = F.when(kind.isin("card", "ssn", "phone", "iban"), bare).when(kind == "born", F.coalesce(date, raw)).otherwise(F.lower(raw))
    words, gender = name_words(raw), gender_of(raw)
    name = F.transform(words, lambda w, i: F.struct(
        F.when(i == F.size(words) - 1, "surname").otherwise("first").alias("kind"), F.when(i == F.size(words) - 1, "").otherwise(gender).alias("sub"), F.lower(w).alias("norm")))
    return F.when(kind == "name", name).otherwise(F.array(F.struct(kind.alias("kind"), F.lit("").alias("sub"), norm.alias("norm"))))


# -- surrogates ------------------------------------------------------------------------------------------------------

def stream(kind: Column, norm: Column, attempt: Column, key: str) -> Column:
    """128 hexadecimal digits that depend on key, type, normal form and attempt."""
    said = F.concat_ws("\x1f", F.lit(key), kind, norm, attempt.cast("string"))
    return F.concat(F.sha2(said, 256), F.sha2(F.concat(said, F.lit("+")), 256))


def nibble(h: Column, i: Column, n: int = 4) -> Column:
    """The number in n hexadecimal digits of h from the i-th group on, round and round."""
    at = F.pmod(i * n, F.lit(128 - n + 1)) + 1
    return F.conv(F.substring(h, at, F.lit(n)), 16, 10).cast("long")


def picked(values: list[str] | str, number: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (F.pmod(number, F.lit(len(values))) + 1).cast("int"))


def letterwise(norm: Column, h: Column, hexadecimal: Column) -> Column:
    """Each digit of norm for a digit and each letter for one of its script; the rest stays."""
    def one(c: Column, i: Column) -> Column:
        n = nibble(h, i)
        return F.when(c.rlike(r"\p{N}"), F.when(hexadecimal, picked("0123456789abcdef", n)).otherwise(picked("0123456789", n))).when(
            hexadecimal & c.rlike("[a-f]"), picked("0123456789abcdef", n)).when(
            c.rlike(r"\p{IsCyrillic}"), picked("абвгдежзиклмнопрстуфхцчшэюя", n)).when(
            c.rlike(r"\p{IsGreek}"), picked("αβγδεζηθικλμνξοπρστυφχψω", n)).when(
            c.rlike(r"\p{L}"), picked("abcdefghijklmnopqrstuvwxyz", n)).otherwise(c)

    return F.array_join(F.transform(F.filter(F.split(norm, ""), lambda c: c != ""), one), "")


def luhn(digits: Column) -> Column:
    """The sum whose last digit is 0 for valid card numbers."""
    d = F.transform(F.filter(F.split(F.reverse(digits), ""), lambda c: c != ""), lambda c, i: F.when(
        i % 2 == 1, c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)).otherwise(c.cast("int")))
    return F.aggregate(d, F.lit(0), lambda a, x: a + x)


def syllables(table: dict, script: Column, number: Column) -> Column:
    """One of the script's syllables."""
    return F.element_at(F.element_at(F.create_map(*[F.lit(x) if isinstance(x, str) else F.array(*map(F.lit, x)) for pair in table.items() for x in pair]), script),
                        (F.pmod(number, F.lit(16)) + 1).cast("int"))


def invented(script: Column, h: Column, more: Column, place: Column) -> Column:
    """An invented name in a script: a start and more + 1 ends."""
    ends = F.array_join(F.transform(F.sequence(F.lit(0), more), lambda i: syllables(ENDS, script, nibble(h, i + 4 + place))), "")
    return F.concat(syllables(STARTS, script, nibble(h, F.lit(2) + place)), ends)


def surrogate(kind: Column, sub: Column, norm: Column, script: Column, h: Column, attempt: Column, key: str) -> Column:
    """Something of the same type and script, drawn from h, a stream() of its own: country codes, top-level domains, gender, script, street words and card checksums stay.

    Names, users and addresses get longer with every attempt, other types from the TRIES-th attempt on.
    """
    zero = F.lit(0)
    domain, user = F.substring_index(norm, "@", -1), F.substring_index(norm, "@", 1)
    top, rest = F.substring_index(domain, ".", -1), F.regexp_replace(domain, r"\.\p{L}+$", "")
    longer = letterwise(F.repeat(F.lit("x"), F.greatest(zero, attempt - 1)), F.reverse(h), F.lit(False))
    # a domain has one surrogate, whoever its users are
    email = F.concat(letterwise(user, h, F.lit(False)), longer, F.lit("@"), letterwise(rest, stream(F.lit("domain"), domain, zero, key), F.lit(False)), F.lit("."), top)
    octet = lambda i: (F.pmod(nibble(h, i), F.lit(254)) + 1).cast("string")
    ip = F.array_join(F.transform(F.sequence(F.lit(0), 3 + F.greatest(zero, attempt - TRIES)), octet), ".")
    extra = letterwise(F.repeat(F.lit("0"), F.greatest(zero, attempt - TRIES)), F.reverse(h), F.lit(False))
    digits = letterwise(norm, h, F.lit(False))
    # the check digit is set so that a valid card number stays valid
    check = F.pmod(10 - F.pmod(luhn(F.concat(F.substring(digits, F.lit(1), F.length(digits) - 1), F.lit("0"))), F.lit(10)), F.lit(10))
    card = F.when(F.pmod(luhn(norm), F.lit(10)) == 0, F.concat(F.substring(digits, F.lit(1), F.length(digits) - 1), check.cast("string"))).otherwise(digits)
    iban = F.concat(F.substring(norm, 1, 2), F.substring(digits, F.lit(3), F.length(digits)))
    # days of 110 years are put in another order, whose step has no factor in common with their number
    days, origin = 40_177, F.lit("1900-01-01").cast("date")
    day = F.datediff(F.to_date(F.when(norm.rlike(r"^\d{4}-\d\d-\d\d$"), norm)), origin)
    step = nibble(F.sha2(F.lit(f"{key}/born"), 256), zero, 4) % (days - 1) + 1
    born = F.coalesce(F.date_add(origin, F.pmod(day * step + 7919 * (attempt + 1), F.lit(days)).cast("int")).cast("string"), digits)
    words = F.split(norm, " ")
    street = rf"^(?:{STREET_AFTER.lower()}|{STREET_BEFORE}|de|la|du|des|del)$"
    address = F.array_join(F.transform(words, lambda w, i: F.when(w.rlike(r"^\d+,?$"), F.concat((F.pmod(nibble(h, i), F.lit(998)) + 1).cast("string"), F.regexp_extract(w, ",", 0))).when(
        w.rlike(street), w).when(w.rlike(f"(?:{STREET_END})$"), F.concat(F.lower(invented(script, h, attempt, i)), F.regexp_extract(w, f"(?:{STREET_END})$", 0))).otherwise(
        F.concat(F.lower(invented(script, h, attempt, i)), F.regexp_extract(w, ",$", 0)))), " ")

    male, female = ({s: names for (s, g), names in FIRST.items() if g == x} for x in "mf")
    woman = (sub == "f") | ((sub == "n") & (F.pmod(nibble(h, F.lit(9)), F.lit(2)) == 0))
    one = lambda i: F.when(woman, syllables(female, script, nibble(h, i))).otherwise(syllables(male, script, nibble(h, i)))
    # every further attempt is a double name with one more
    first = F.when(script.isin(*male), F.array_join(F.transform(F.sequence(F.lit(0), attempt), one), "-")).otherwise(invented(script, h, attempt, zero))

    return (F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "card", F.concat(card, extra)).when(kind == "iban", F.concat(iban, extra)).when(kind == "born", born)
            .when(kind == "address", address).when(kind == "secret", F.concat(letterwise(norm, h, norm.rlike("^[0-9a-f]+$")), extra))
            .when(kind == "first", first).when(kind == "surname", invented(script, h, attempt, zero))
            .otherwise(F.concat(F.when(norm.rlike("^1\\d{10}$"), F.concat(F.lit("1"), F.substring(digits, F.lit(2), F.length(digits)))).otherwise(digits), extra)))


def formatted(kind: Column, raw: Column, surs: Column) -> Column:
    """The surrogates of a match's parts in its format: its title, separators and capitals."""
    sur = F.element_at(surs, 1)
    chars = F.filter(F.split(raw, ""), lambda c: c != "")
    filled = F.aggregate(
        chars, F.struct(F.lit("").alias("out"), F.lit(1).alias("at")),
        lambda a, c: F.struct(
            F.concat(a["out"], F.when(c.rlike(r"[\p{L}\p{N}]"), F.when(c.rlike(r"\p{Lu}"), F.upper(F.substring(sur, a["at"], F.lit(1)))).otherwise(
                F.substring(sur, a["at"], F.lit(1)))).otherwise(c)).alias("out"),
            (a["at"] + c.rlike(r"[\p{L}\p{N}]").cast("int")).alias("at")))
    number = F.concat(filled["out"], F.substring(sur, filled["at"], F.length(sur)))
    upper = (raw == F.upper(raw)) & raw.rlike(r"\p{Lu}")
    name = F.concat(title_of(raw), F.array_join(surs, " "))
    groups = [F.regexp_extract(raw, r"^(\d+)([./-])(\d+)([./-])(\d+)$", k) for k in range(1, 6)]
    ahead = F.length(groups[0]) == 4
    y, m, d = (F.split_part(sur, F.lit("-"), F.lit(k)) for k in (1, 2, 3))
    short = lambda x, like: F.when(F.length(like) == 1, F.regexp_replace(x, "^0", "")).otherwise(x)
    born = F.when(sur.rlike("^\\d{4}-"), F.concat(F.when(ahead, y).otherwise(short(d, groups[0])), groups[1], short(m, groups[2]), groups[3],
                                                  F.when(ahead, short(d, groups[4])).otherwise(y))).otherwise(number)
    return (F.when(kind.isin("card", "ssn", "phone", "iban"), number).when(kind == "born", born)
            .when(kind == "name", F.when(upper & (F.length(title_of(raw)) < F.length(raw)), F.upper(name)).otherwise(name))
            .when(kind == "address", F.when(upper, F.upper(sur)).otherwise(F.initcap(sur))).otherwise(F.when(upper, F.upper(sur)).otherwise(sur)))


def assigned(entities: DataFrame, key: str) -> DataFrame:
    """A surrogate for each (kind, sub, norm): never the normal form of an entity of its kind, never that of two.

    All take their first attempt; of entities with the same surrogate the least keeps it, and those whose surrogate is
    itself an entity or kept by another try again, until none does.  As surrogates get longer with attempts, there is an
    end even where the entities take up all there is of a format.
    """
    keep = None
    rest = entities.select("kind", "sub", "norm", F.lit(0).alias("attempt"))
    known = entities.select("kind", F.col("norm").alias("low")).distinct()
    me = F.struct("sub", "norm")
    while True:
        drawn = rest.withColumns({"h": stream(F.concat_ws("/", "kind", "sub"), F.col("norm"), F.col("attempt"), key), "script": script_of(F.col("norm"))})
        tried = drawn.withColumn("sur", surrogate(*map(F.col, ("kind", "sub", "norm", "script", "h", "attempt")), key)).drop("h", "script")
        tried = written(tried.withColumn("low", F.lower("sur")), "tried")
        least = tried.groupBy("kind", "low").agg(F.min(me).alias("least"))
        taken = known if keep is None else known.unionByName(keep.select("kind", "low"))
        free = least.join(taken, ["kind", "low"], "left_anti").select("kind", "low", "least.sub", "least.norm")
        good = written(tried.join(free, ["kind", "low", "sub", "norm"], "left_semi").select("kind", "sub", "norm", "sur", "low"), "good")
        keep = good if keep is None else keep.unionByName(good)
        again = tried.join(good, ["kind", "sub", "norm"], "left_anti")
        rest = written(again.select("kind", "sub", "norm", (F.col("attempt") + 1).alias("attempt")), "again")
        if rest.isEmpty():
            return keep.drop("low")


def surrogates(docs: DataFrame, key: str = KEY) -> DataFrame:
    """docs with every entity of `text` replaced, and `entities`, an array of (kind, surrogate) in the order of the text.

    E-mail addresses, secrets, IBANs, card, social security and phone numbers, IP addresses, dates of birth behind a word
    that says so, street addresses, and names are found by pattern: names behind a title, before a mark of respect, or
    that begin with a known first name; surnames of a text's names are then found wherever else they stand in it.  Other
    names without a title are not found.  An entity gets the same surrogate wherever it occurs and however it is written;
    different entities get different ones (see assigned()).

    Null texts stay null, empty ones empty, both without entities; very long ones are searched whole, in one pass over
    all texts; rows that repeat are kept; an `entities` column of docs is replaced, other columns may have any name; no
    rows give no rows.
    """
    cols = [c for c in docs.columns if c != "entities"]
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("row"), found_in(F.col("text")).alias("raws"))
    held = written(held, "searched")
    out = lambda d, text, entities: d.select(*[text.alias(c) if c == "text" else F.col("row").getField(c).alias(c) for c in cols], entities.alias("entities"))
    plain = out(held.filter(F.size("raws") == 0), F.col("row.text"), F.expr("cast(array() as array<struct<kind:string,surrogate:string>>)"))
    found = held.filter(F.size("raws") > 0).withColumn("digest", F.md5("row.text"))
    # surnames of the text's names, in the capitals that they may have elsewhere
    found = found.withColumn("names", F.transform(F.filter("raws", lambda r: kind_of(r) == "name"), lambda r: F.element_at(name_words(r), -1)))
    found = found.withColumn("names", F.array_distinct(F.concat("names", F.transform("names", F.upper), F.transform("names", F.initcap))))
    found = found.withColumn("names", F.filter("names", lambda w: w.rlike(r"^[\p{L}\p{M}'’-]{2,}$")))
    bare = F.concat(F.lit(ANY + r"|(?<![\p{L}\p{N}])(?:"), F.array_join(F.transform("names", lambda w: F.concat(F.lit("\\Q"), w, F.lit("\\E"))), "|"), F.lit(r")(?![\p{L}\p{N}])"))
    found = found.withColumn("pattern", F.when(F.size("names") > 0, bare)).drop("names")
    found = found.withColumn("raws", F.when(F.col("pattern").isNotNull(), F.regexp_extract_all("row.text", F.col("pattern"), F.lit(0))).otherwise(F.col("raws")))
    found = written(found, "found")
    texts = found.groupBy("digest").agg(F.first("raws").alias("raws"), F.count(F.lit(1)).alias("n"))
    spots = texts.select("digest", F.posexplode("raws").alias("at", "raw")).withColumn("kind", kind_of(F.col("raw")))
    spots = spots.select("digest", "at", "raw", F.col("kind").alias("of"), F.posexplode(parts_of(F.col("kind"), F.col("raw"))).alias("place", "part"))
    spots = written(spots.select("digest", "at", "raw", "of", "place", "part.*"), "spots")
    entities = written(spots.groupBy("kind", "sub", "norm").agg(F.count(F.lit(1)).alias("n")), "entities")
    chosen = assigned(entities, key).join(entities, ["kind", "sub", "norm"])
    whole = lambda d: d.withColumn("entity", F.concat_ws("\x1f", "kind", "sub", "norm"))
    spots = attach(whole(spots), whole(chosen).select("entity", "sur", "n"), "entity", F.concat_ws(":", "digest", "at"), spots.count())
    spots = spots.groupBy("digest", "at", "raw", "of").agg(F.transform(F.sort_array(F.collect_list(F.struct("place", "sur"))), lambda p: p["sur"]).alias("surs"))
    spots = spots.withColumn("new", formatted(F.col("of"), F.col("raw"), F.col("surs")))
    made = spots.groupBy("digest").agg(F.sort_array(F.collect_list(F.struct("at", "of", "new"))).alias("made"))
    made = written(made.join(texts.select("digest", "n"), "digest"), "made")
    done = attach(found, made, "digest", F.xxhash64("row.doc_id", "digest"), found.count())
    news = F.concat(F.transform("made", lambda m: m["new"]), F.array(F.lit("")))
    between = F.when(F.col("pattern").isNull(), F.split("row.text", ANY, -1)).otherwise(F.split(F.col("row.text"), F.col("pattern"), F.lit(-1)))
    text = F.array_join(F.zip_with(between, news, lambda a, b: F.concat(a, b)), "")
    kinds = F.transform("made", lambda m: F.struct(m["of"].alias("kind"), m["new"].alias("surrogate")))
    return plain.unionByName(out(done, text, kinds))
