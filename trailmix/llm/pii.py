"""Personal data: detected entities are replaced by surrogates.

Detection finds e-mail addresses, phone numbers (international, US and with a
leading 0), IPv4 and IPv6 addresses, card numbers (Luhn) and IBANs (mod 97)
also with other numbers or words beside them, social security numbers, access
keys, assigned passwords and tokens, and person names (a known given name, a
title or words such as "my name is" before a capitalised name, in Latin,
Cyrillic or Greek script; other names are not found).  Every occurrence has a
kind and a canonical form, so two spellings of one entity are one entity.

A surrogate is drawn from HMAC-SHA-256(key, kind, canonical form, attempt): the
same entity gets the same surrogate in every document (coreference).  It is of
the same kind, and valid as such: letters for letters of the same case and
script, digits for digits, a card keeps its length and first digit and gets
its check digit, an IBAN its country and check digits, a given name stays of
its gender and script.  The collision check runs over all entities of the
corpus: a surrogate that another entity has, or that is itself an entity of
the corpus, is given up and the entity's next attempt is drawn, until all are
distinct.

Texts without any digit, @, title or known name are told apart by a quick test
over Arrow batches and passed on; only the others reach a shuffle.

Defined results.  Null text: as it is.  Empty text, null ids, repeated rows:
by their text, equal texts get equal results.  Empty table: no rows.  Extra
columns are not read (``replace_in_rows`` keeps them).
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import re
import string
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmix.llm.common import give_back, pick, Rows, ship, written

# Texts that a task has as Python strings at a time.
_SLICE_ROWS = 256
MAX_ATTEMPTS = 100

# Given names by script and gender, titles by gender.
GIVEN = {
    ("latin", "m"): "James John Robert Michael William David Richard Thomas Charles Daniel Matthew Andrew Joshua Kevin Brian "
                    "George Edward Peter Hans Klaus Jürgen Wolfgang Stefan Pierre Jacques Michel Philippe François "
                    "Carlos Miguel Javier Fernando Alejandro Francisco".split(),
    ("latin", "f"): "Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Nancy Margaret Emily Michelle "
                    "Laura Rebecca Ursula Monika Sabine Renate Heike Brigitte Nathalie Isabelle Françoise Sylvie "
                    "Carmen Dolores Lucía Isabel Mercedes Beatriz".split(),
    ("cyrillic", "m"): "Александр Дмитрий Сергей Андрей Алексей Максим Иван Михаил Николай Владимир".split(),
    ("cyrillic", "f"): "Елена Ольга Наталья Анна Татьяна Ирина Мария Светлана Екатерина Юлия".split(),
    ("greek", "m"): "Γιώργος Δημήτρης Κώστας Γιάννης Νίκος Παναγιώτης Βασίλης Χρήστος".split(),
    ("greek", "f"): "Μαρία Ελένη Κατερίνα Βασιλική Σοφία Αγγελική Γεωργία Δήμητρα".split(),
}
TITLES = {"m": ["Mr", "Mister", "Herr", "Monsieur", "Señor"], "f": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora"],
          "": ["Dr", "Prof", "Doctor", "Professor", "Sir", "Dra"]}
# Given names that are only found; surrogates are drawn from GIVEN.
MORE_GIVEN = {
    ("latin", "m"): "Christopher Joseph Anthony Donald Steven Paul Kenneth Ronald Timothy Jason Jeffrey Ryan Jacob Gary Nicholas Eric "
                    "Jonathan Stephen Larry Justin Scott Brandon Benjamin Samuel Gregory Alexander Patrick Jack Dennis Jerry Tyler "
                    "Aaron Jose Adam Nathan Henry Douglas Zachary Kyle Noah Ethan Jeremy Walter Christian Keith Roger Terry Harry "
                    "Gerald Carl Dylan Arthur Lawrence Jordan Jesse Bryan Billy Bruce Gabriel Logan Albert Willie Alan Juan Wayne "
                    "Randy Roy Vincent Ralph Eugene Russell Bobby Mason Philip Louis Tom Tim Jim Joe Ben Sam Mike Dave Bob Nick "
                    "Andreas Michael Thomas Jan Matthias Martin Markus Sebastian Tobias Florian Felix Lukas Maximilian Leon Jonas "
                    "Uwe Jens Ralf Dieter Günter Günther Helmut Heinz Horst Manfred Werner Karl Friedrich Otto Johannes Christoph "
                    "Jean Claude Alain Bernard Gérard Patrice Laurent Nicolas Julien Guillaume Antoine Mathieu Olivier Thierry "
                    "Christophe Sébastien Frédéric Stéphane Éric Luc Marc Hugo José Antonio Manuel Luis Jesús Pedro Pablo Sergio "
                    "Diego Rafael Ángel Álvaro Adrián Raúl Enrique Ramón Vicente Andrés Joaquín Marco Luca Giuseppe Giovanni "
                    "Andrea Paolo Matteo Lorenzo João Mohammed Muhammad Ahmed Ali Omar Hassan Ibrahim Yusuf Mustafa Wei Ming "
                    "Hiroshi Takashi Kenji Raj Rahul Amit Sanjay Vijay Arjun Lars Erik Anders Sven Piotr Krzysztof".split(),
    ("latin", "f"): "Lisa Betty Sandra Ashley Kimberly Donna Carol Amanda Dorothy Melissa Deborah Stephanie Sharon Cynthia Kathleen "
                    "Amy Angela Shirley Anna Brenda Pamela Emma Nicole Helen Samantha Katherine Christine Debra Rachel Carolyn "
                    "Janet Catherine Maria Heather Diane Ruth Julie Olivia Joyce Virginia Victoria Kelly Lauren Christina Joan "
                    "Evelyn Judith Megan Andrea Cheryl Hannah Jacqueline Martha Gloria Teresa Ann Anne Sara Madison Frances "
                    "Kathryn Janice Jean Abigail Alice Julia Judy Sophia Denise Amber Doris Marilyn Danielle Beverly Theresa Diana "
                    "Brittany Natalie Charlotte Marie Kayla Alexis Lori Jane Kate Lucy Claudia Petra Birgit Andrea Stefanie "
                    "Nicole Katharina Susanne Martina Gabriele Angelika Karin Ingrid Helga Gisela Christa Erika Hannelore Elke "
                    "Anja Silke Kerstin Tanja Lena Lea Johanna Sophie Céline Camille Chloé Manon Léa Julie Aurélie Émilie Sandrine "
                    "Valérie Véronique Catherine Martine Monique Jacqueline Hélène Élise Claire Ana María Josefa Pilar Teresa "
                    "Cristina Marta Elena Raquel Paula Rosa Silvia Rocío Inés Sofía Giulia Francesca Chiara Fatima Aisha Leila "
                    "Yuki Priya Anjali Ingrid Astrid Agnieszka Katarzyna Małgorzata".split(),
    ("cyrillic", "m"): "Евгений Виктор Олег Павел Роман Артём Игорь Юрий Борис Константин Денис Антон Виталий Василий Пётр Григорий "
                       "Никита Илья Кирилл Леонид Анатолий Валерий Вячеслав Даниил".split(),
    ("cyrillic", "f"): "Людмила Галина Валентина Надежда Виктория Дарья Анастасия Полина Ксения Алёна Вера Любовь Нина Тамара Лариса "
                       "Марина Оксана Евгения Вероника Александра Софья".split(),
    ("greek", "m"): "Αλέξανδρος Αντώνης Ανδρέας Μιχάλης Θανάσης Σπύρος Στέλιος Θοδωρής Πέτρος Μανώλης Ιωάννης Γεώργιος".split(),
    ("greek", "f"): "Άννα Αναστασία Ιωάννα Χριστίνα Δέσποινα Ευαγγελία Παναγιώτα Κωνσταντίνα Αικατερίνη Ειρήνη Ζωή".split(),
}
_GENDER = {name: (script, g) for lexicon in (MORE_GIVEN, GIVEN) for (script, g), names in lexicon.items() for name in names}
_SYLLABLES = {
    "latin": ("b d f g k l m n p r s t v br tr st".split(), "a e i o u".split(), ["n", "r", "l", "s", ""]),
    "cyrillic": ("б в г д к л м н п р с т".split(), "а е и о у".split(), ["в", "н", "р", "к", ""]),
    "greek": ("β γ δ κ λ μ ν π ρ τ".split(), "α ε ι ο".split(), ["ς", "ν", ""]),
}
_UP = "A-ZÀ-ÖØ-ÞŁŚŽŠΑ-ΩΆΈΉΊΌΎΏА-ЯЁ"
_LOW = "a-zß-öø-ÿłśžšα-ωάέήίόύώА-Яа-яё"
_NAME = rf"[{_UP}][{_LOW}]+(?:-[{_UP}][{_LOW}]+)*"
_TITLE = "|".join(t for ts in TITLES.values() for t in ts)
_FIRST = "|".join(sorted(_GENDER, key=len, reverse=True))
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"

# Kinds in order of precedence where two overlap.
PATTERNS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"),
    ("access_key", r"\b(?:AKIA|ASIA)[0-9A-Z]{16}\b"),
    ("secret", r"(?i:\b(?:password|passwd|pwd|secret|token|api[_-]?key)\b\s*[=:]\s*[\"']?)([A-Za-z0-9_/+.~-]*[0-9][A-Za-z0-9_/+~-]{6,}|[A-Za-z0-9_/+~-]{7,}[0-9])"),
    ("iban", r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]){11,30}"),
    ("ip", rf"(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\.?\d)"),
    ("ipv6", r"(?<![\w:.])(?=[0-9A-Fa-f:]*\d)(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?=[0-9A-Fa-f:]*::)[0-9A-Fa-f:]{3,39})(?<!(?<!:):)(?![\w:]|\.\d)"),
    ("card", r"(?<![\d+.-])\d+(?:[ -]\d+)*"),
    ("ssn", r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"),
    ("phone", r"(?<![\w+])(?=[+(0-9])(?:(?:\+\d{1,3}[ .-]?|00[1-9]\d{0,2}[ .-])(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4}"
              r"|(?<!\d )[2-9]\d{2} \d{3} \d{4}(?! \d)|0[1-9]\d{0,3}(?P<s>[ .-])\d{2,4}(?:(?P=s)\d{2,4}){1,4}|0[1-9]\d{1,3}[ /-]\d{5,8}"
              r"|\(0[1-9]\d{0,3}\) ?\d{3,8}(?:[ -]\d{2,5}){0,2})(?!\w)"),
]
_NAMES = re.compile(rf"\b(?=[{_UP}][{_LOW}])(?:(?:(?:{_TITLE})\.? )+{_NAME}(?: {_NAME})?|(?:{_FIRST})(?:-[{_UP}][{_LOW}]+)*(?: {_NAME})+)")
# Words after which a name stands: alone, or two names and more.
_LEAD = "[Mm]y name is|[Mm]ein Name ist|[Ii]ch heiße|[Jj]e m[’']appelle|[Mm]e llamo|[Mm]i nombre es|[Мм]еня зовут|[Μμ]ε λένε"
_LEAD_FULL = ("(?:[Ff]ull |[Ff]irst |[Ll]ast )?[Nn]ame ?:|[Aa]pplicant ?:|[Pp]atient ?:|[Cc]ustomer ?:|[Aa]uthor ?:|[Cc]ontact ?:|[Ss]igned(?: by|:|,)|"
              "[Ww]ritten by|[Rr]egards,|[Ss]incerely,|Grüßen,?|[Cc]ordialement,?|[Ss]aludos,?")
_CONTEXT = re.compile(rf"(?<!\w)(?:(?:{_LEAD})\s+(?P<a>{_NAME}(?: {_NAME}){{0,2}})|(?:{_LEAD_FULL})\s+(?P<b>{_NAME}(?: {_NAME}){{1,2}}))")
# A part of each of these words: a quick test that misses none.
_HINTS = ("name is", "Name ist", "heiße", "appelle", "llamo", "nombre es", "зовут", "λένε", "ame:", "ame :", "pplicant", "atient", "ustomer",
          "uthor", "ontact", "igned", "ritten by", "egards,", "incerely,", "Grüßen", "ordialement", "aludos")
# Characters of the IBANs of each country.
_IBAN_SIZES = {15: "NO",
               16: "BE",
               18: "DK FI FO GL NL",
               19: "MK SI",
               20: "AT BA EE KZ LT LU XK",
               21: "HR LV LI CH",
               22: "BH BG CR DE GB GE IE ME RS VA",
               23: "AE GI IL IQ TL",
               24: "AD CZ ES MD PK RO SA SE SK TN VG",
               25: "PT",
               26: "IS TR",
               27: "FR GR IT MC MR SM",
               28: "AL AZ BY CY DO GT HU LB PL",
               29: "BR PS QA UA",
               30: "JO KW MU",
               31: "MT SC",
               32: "LC"}
IBAN = {c: n for n, cs in _IBAN_SIZES.items() for c in cs.split()}
_CARD_SHAPES = {(4, 4, 4, 4), (4, 6, 5), (4, 6, 4), (4, 4, 4, 4, 3), (4, 4, 4, 1)}
_PATTERNS = [(k, re.compile(p)) for k, p in PATTERNS]
# What every entity has: a digit or @, or a title or known name.
_SIGN = re.compile("[0-9@]")
_CAPITALISED = re.compile(rf"[{_UP}][{_LOW}]+")
_KNOWN = {*_TITLE.split("|"), *_FIRST.split("|")}


def may_hold(text: str | None) -> bool:
    """Whether a text can have an entity: a quick test that misses none."""
    return bool(text) and (_SIGN.search(text) is not None or not _KNOWN.isdisjoint(_CAPITALISED.findall(text))
                           or any(h in text for h in _HINTS))


def luhn(digits: str) -> bool:
    twice = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d // 10 + d % 10 for d in twice) % 10 == 0


def _iban_rest(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97


def canonical(kind: str, found: str) -> str | None:
    """The entity that an occurrence stands for; None: it is not one."""
    if kind == "email":
        return found.lower()
    if kind in ("card", "phone", "ssn"):
        digits = re.sub(r"\D", "", found)
        if kind == "card":
            return digits if luhn(digits) and len(set(digits)) > 1 else None
        if kind == "phone":
            if len(digits) < 9:
                return None
            if digits.startswith("00"):
                return digits[2:]
            return digits[1:] if len(digits) == 11 and digits[0] == "1" else digits
        return digits
    if kind == "iban":
        plain = found.replace(" ", "")
        return plain if 15 <= len(plain) <= 34 and _iban_rest(plain) == 1 else None
    if kind == "ipv6":
        try:
            return ipaddress.IPv6Address(found).exploded
        except ValueError:
            return None
    return found


def _ibans(text: str, pattern: re.Pattern) -> Iterator[tuple[int, int]]:
    """Spans of valid IBANs: as long as their country's, else any length."""
    m = pattern.search(text)
    while m:
        at, places = m.start(), [i + 1 for i in range(*m.span()) if text[i] != " "]
        sizes = [IBAN[m[0][:2]]] if m[0][:2] in IBAN else range(len(places), 14, -1)
        ends = [places[n - 1] for n in sizes if n <= len(places)]
        stop = next((e for e in ends if not text[e:e + 1].isalnum() and canonical("iban", text[at:e])), None)
        if stop:
            yield at, stop
        m = pattern.search(text, stop or at + 1)


def _cards(text: str, pattern: re.Pattern) -> Iterator[tuple[int, int]]:
    """Spans of valid cards: all of a row of digit groups, or groups of it in
    the way cards are written."""
    for m in pattern.finditer(text):
        groups = [(m.start() + g.start(), m.start() + g.end()) for g in re.finditer(r"\d+", m[0])]
        if 13 <= sum(z - a for a, z in groups) <= 19 and text[m.end():m.end() + 1] != "-" and canonical("card", m[0]):
            yield m.span()
            continue
        i = 0
        while i < len(groups):
            for n in (5, 4, 3, 1):
                shape = tuple(z - a for a, z in groups[i:i + n])
                if len(shape) == n and (shape in _CARD_SHAPES or n == 1 and 13 <= shape[0] <= 19) and text[groups[i][0]] in "23456":
                    at, stop = groups[i][0], groups[i + n - 1][1]
                    if canonical("card", text[at:stop]):
                        yield at, stop
                        i += n - 1
                        break
            i += 1


def _spans(kind: str, pattern: re.Pattern, text: str) -> Iterator[tuple[int, int]]:
    if kind == "iban":
        return _ibans(text, pattern)
    if kind == "card":
        return _cards(text, pattern)
    if kind == "ipv6" and text.count(":") < 2:
        return iter(())
    return (m.span(1 if kind == "secret" else 0) for m in pattern.finditer(text))


def detect(text: str) -> list[tuple[int, int, str, str]]:
    """(start, stop, kind, canonical form), in order, without overlaps."""
    if not may_hold(text):
        return []
    found: list[tuple[int, int, str, str]] = []
    taken: list[tuple[int, int]] = []
    for kind, pattern in _PATTERNS:
        for at, stop in _spans(kind, pattern, text):
            entity = canonical(kind, text[at:stop])
            if entity is not None and not any(a < stop and at < b for a, b in taken):
                found.append((at, stop, kind, entity))
                taken.append((at, stop))
    named = [m.span() for m in _NAMES.finditer(text)]
    if any(h in text for h in _HINTS):
        named += [m.span("a" if m["a"] else "b") for m in _CONTEXT.finditer(text)]
    for at, end in named:
        if any(a < end and at < b for a, b in taken):
            continue
        taken.append((at, end))
        for word in text[at:end].split(" "):
            stop = at + len(word)
            if word.rstrip(".") not in _TITLE.split("|"):
                script = "greek" if word[0] >= "\u0370" and word[0] < "\u0400" else "cyrillic" if "\u0400" <= word[0] < "\u0530" else "latin"
                first = word if word in _GENDER else word.split("-")[0]
                if first in _GENDER:
                    found.append((at, stop, f"given_{_GENDER[first][1]}_{script}", word))
                else:
                    found.append((at, stop, f"surname_{script}", word))
            at = stop + 1
    return sorted(found)


class _Draw:
    """A keyed stream of choices."""

    def __init__(self, key: bytes, *parts: object):
        self.key, self.seed, self.n, self.pool = key, "\0".join(map(str, parts)).encode(), 0, b""

    def below(self, n: int) -> int:
        if len(self.pool) < 4:
            self.pool = hmac.new(self.key, self.seed + b"\0%d" % self.n, hashlib.sha256).digest()
            self.n += 1
        v, self.pool = int.from_bytes(self.pool[:4], "big"), self.pool[4:]
        return v % n

    def of(self, items):
        return items[self.below(len(items))]

    def like(self, text: str) -> str:
        """Letters for letters, digits for digits, hexadecimal for hexadecimal."""
        if len(text) >= 8 and re.search("[a-fA-F]", text) and re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", text):
            return "".join(self.of("0123456789abcdef" if text.lower() == text else "0123456789ABCDEF") for _ in text)
        return "".join(self.of(string.digits) if c.isdigit() else self.of(string.ascii_lowercase) if c.islower()
                       else self.of(string.ascii_uppercase) if c.isupper() else c for c in text)


def surrogate(key: bytes, kind: str, entity: str, attempt: int) -> str:
    """The canonical form of the surrogate drawn at an attempt.  From the
    eighth attempt on an open form grows longer, so that short forms do not
    run out."""
    draw = _Draw(key, kind, entity, attempt)
    more = max(0, attempt - 7)
    if kind == "email":
        local, _, domain = entity.partition("@")
        labels = domain.split(".")
        hosts = [draw.like(x) for x in labels[:-2]]
        return draw.like(local + "x" * more) + "@" + ".".join([*hosts, "example", draw.of(["org", "net", "com"])])
    if kind == "ip":
        return f"{240 + draw.below(15)}." + ".".join(str(draw.below(256)) for _ in range(3))
    if kind == "ipv6":
        return "2001:0db8:" + ":".join(f"{draw.below(65_536):04x}" for _ in range(6))
    if kind == "card":
        body = entity[0] + "".join(draw.of(string.digits) for _ in entity[2:])
        return next(body + c for c in string.digits if luhn(body + c))
    if kind == "ssn":
        return "9" + "".join(draw.of(string.digits) for _ in entity[1:])
    if kind == "phone":
        if entity[0] == "0":
            return "0" + draw.of("123456789") + "".join(draw.of(string.digits) for _ in entity[2:])
        return draw.of("23456789") + "".join(draw.of(string.digits) for _ in entity[1:])
    if kind == "iban":
        body = draw.like(entity[4:])
        return f"{entity[:2]}{98 - _iban_rest(entity[:2] + '00' + body):02d}{body}"
    if kind == "access_key":
        return entity[:4] + "".join(draw.of("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in entity[4:])
    if kind.startswith("given_"):
        _, gender, script = kind.split("_")
        names = GIVEN[script, gender]
        return "-".join(draw.of(names) for _ in range(1 + (attempt > 3) + more))
    if kind.startswith("surname_"):
        onset, core, coda = _SYLLABLES[kind.split("_")[1]]
        parts = [draw.of(onset) + draw.of(core) for _ in range(2 + draw.below(2) + more)]
        return ("".join(parts) + draw.of(coda)).capitalize()
    return draw.like(entity + "x" * more)


def render(kind: str, found: str, entity: str, new: str) -> str:
    """A surrogate in the format of an occurrence."""
    if kind in ("card", "phone", "ssn"):
        digits = re.sub(r"\D", "", found)
        fill = iter(digits[:len(digits) - len(new)] + new)
        return "".join(next(fill) if c.isdigit() else c for c in found)
    if kind == "iban":
        fill = iter(new)
        return "".join(c if c == " " else next(fill) for c in found)
    if kind == "email" and found.isupper():
        return new.upper()
    return new


def apply(text: str, surrogates: dict[tuple[str, str], str]) -> tuple[str, list[str]]:
    """The text with its entities replaced, and their kinds in order."""
    out, at, kinds = [], 0, []
    for start, stop, kind, entity in detect(text):
        out += [text[at:start], render(kind, text[start:stop], entity, surrogates[kind, entity])]
        at = stop
        kinds.append(kind)
    return "".join(out) + text[at:], kinds


def resolve(entities: DataFrame, key: bytes, attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """(kind, entity, surrogate) of distinct (kind, entity): no two alike, none
    an entity itself."""
    def drawn(attempt: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                kinds, entities = b.column("kind").to_pylist(), b.column("entity").to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [b.column("kind"), b.column("entity"),
                     pa.array([surrogate(key, k, e, attempt) for k, e in zip(kinds, entities, strict=True)], pa.string())],
                    ["kind", "entity", "surrogate"])
        return run

    schema = "kind string, entity string, surrogate string"
    entities = written(entities, "entities")
    left, done = entities, None
    for attempt in range(attempts):
        made = written(left.mapInArrow(drawn(attempt), schema), f"drawn-{attempt}")
        free = made.join(entities.select("kind", F.col("entity").alias("surrogate")), ["kind", "surrogate"], "left_anti")
        if done is not None:
            free = free.join(done.select("kind", "surrogate"), ["kind", "surrogate"], "left_anti")
        # Of the entities that drew one surrogate the least has it.
        won = written(free.groupBy("kind", "surrogate").agg(F.min("entity").alias("entity")).select("kind", "entity", "surrogate"), f"won-{attempt}")
        done = won if done is None else done.union(won)
        left = written(left.join(won, ["kind", "entity"], "left_anti"), f"left-{attempt}")
        if left.isEmpty():
            return done
    raise RuntimeError(f"surrogates collide after {attempts} attempts")


def _text_key(text: Column) -> Column:
    return F.md5(text.cast("binary"))


def _surrogates(texts: DataFrame, key: bytes) -> DataFrame:
    """(text_key, found: the text's kinds, entities and surrogates) of texts
    (text) that have entities."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, _SLICE_ROWS):
                part = b.slice(lo, _SLICE_ROWS)
                rows = [(part.column("text_key")[i].as_py(), *e) for i, t in enumerate(part.column("text").to_pylist()) if may_hold(t)
                        for e in {x[2:] for x in detect(t)}]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in range(3)], ["text_key", "kind", "entity"])
            give_back()

    found = written(texts.select(_text_key(F.col("text")).alias("text_key"), "text")
                    .mapInArrow(run, "text_key string, kind string, entity string").distinct(), "occurrences")
    known = resolve(found.select("kind", "entity").distinct(), key)
    return (found.join(known, ["kind", "entity"]).groupBy("text_key")
            .agg(F.collect_list(F.struct("kind", "entity", "surrogate")).alias("found")))  # one text's entities


def replace_personal_data(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, text with surrogates, n_replaced, kinds."""
    return _replaced(pick(docs, id=id_col, text=text_col), F.col("text"), key).select(
        F.col("id").alias(id_col), F.col("new_text").alias(text_col), F.size("kinds").alias("n_replaced"), "kinds")


def replace_in_rows(docs: DataFrame, key: bytes, text_col: str = "text", chars_col: str | None = None) -> DataFrame:
    """All rows and columns, the text replaced (and ``chars_col`` set to its
    length, where the text changed)."""
    rows = Rows(docs)
    out = _replaced(rows.df, rows[text_col], key)
    own = rows.own[rows.names.index(text_col)]
    changed = {own: F.col("new_text")}
    if chars_col:
        n = rows.own[rows.names.index(chars_col)]
        changed[n] = F.when(F.size("kinds") > 0, F.char_length("new_text").cast(rows.df.schema[n].dataType)).otherwise(F.col(n))
    return rows.restore(out.withColumns(changed))


def _replaced(rows: DataFrame, text: Column, key: bytes) -> DataFrame:
    """The rows with new_text and kinds."""
    ship(rows.sparkSession)

    @F.arrow_udf("boolean")
    def held(texts: pa.Array) -> pa.Array:
        out = [may_hold(t) for lo in range(0, len(texts), _SLICE_ROWS) for t in texts.slice(lo, _SLICE_ROWS).to_pylist()]
        give_back()
        return pa.array(out, pa.bool_())

    may = held(text)
    flagged = rows.filter(may).withColumn("old_text", text)
    found = _surrogates(rows.select(text.alias("text")), key)
    joined = flagged.withColumn("text_key", _text_key(F.col("old_text"))).join(found, "text_key", "left").drop("text_key")
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, _SLICE_ROWS):
                part, new = b.slice(lo, _SLICE_ROWS), []
                for text, known in zip(part.column("old_text").to_pylist(), part.column("found").to_pylist(), strict=True):
                    new.append(apply(text, {(k["kind"], k["entity"]): k["surrogate"] for k in known}) if known else (text, []))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in names), pa.array([n[0] for n in new], pa.string()), pa.array([n[1] for n in new], pa.list_(pa.string()))],
                    [*names, "new_text", "kinds"])
            give_back()

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    done = joined.mapInArrow(run, f"{kinds}, new_text string, kinds array<string>")
    clean = rows.filter(~may).withColumns({"new_text": text, "kinds": F.array().cast("array<string>")})
    return clean.union(done)
