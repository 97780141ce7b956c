"""Problem 1: broken prompt and response pairs.

One label by pair, the first that holds: ``empty`` (nothing but placeholders),
``copy`` (compressed with the prompt as zstandard dictionary the response
leaves hardly a byte more than the prompt itself, and the prompt hardly more
with the response as dictionary; words of courtesy and labels apart),
``refusal`` (a phrase of the refusal dictionary, and most of the words in
sentences that decline, excuse or refer elsewhere), ``language`` (function
words are those of another language than the prompt asks for or is written
in), ``truncated`` (breaks off where, after a model of the contexts that end
sentences and items in all responses, nothing ends).
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acequia.llm.features import mix, word_hashes
from acequia.llm.splitting import ABBREVIATIONS
from acequia.llm import text as X
from acequia.llm.text import fold, map_rows



@lru_cache(maxsize=32)
def words(text: str | None) -> tuple[str, ...]:
    """Words of a text; those of the last texts are remembered, for each test asks for them again."""
    return tuple(X.words(text))


# Words that stand for an answer or name a role, folded.
PLACEHOLDERS = frozenset(
    """
    null none nil nan na undefined empty vacio vacia pendiente pending todo tbd placeholder blank
    respuesta answer response reponse resposta antwort risposta output salida
    assistant asistente assistent assistente bot modelo model user usuario usuari system sistema human humano gpt ai ia
    """.split()
)
PLACEHOLDER_PHRASES = frozenset({"n a", "s r", "sin respuesta", "no response", "no answer", "sin contenido", "no content", "sans reponse", "sem resposta", "sense resposta", "im end", "im start", "im start assistant"})

_PHRASES = re.compile(r"\b(?:" + "|".join(sorted(PLACEHOLDER_PHRASES, key=len, reverse=True)) + r")\b")
_OPENERS = PLACEHOLDERS | {x.split()[0] for x in PLACEHOLDER_PHRASES}

# Phrases that decline, of the folded text, by language.
REFUSALS = [
    # Spanish
    r"\bno (?:te |le |os |les )?(?:puedo|podre|podemos|podria)\b (?!decir que|confirmar que|descartar)(?:\w+ ){0,3}?(?:ayud|respond|contest|atend|proporcion|facilit|ofrec|generar|dar|cumplir|complac|hacer|asist|resolv|valor|opinar|pronunci|compart|crear|redact|escrib|tratar|procesar|aconsej|asesor|brind|satisf|entrar)",
    r"\bno (?:me|nos) es posible\b",
    r"\b(?:me|nos) (?:es|resulta) imposible (?:ayud|respond|contest|atend|dar|proporcion|facilit)",
    r"\bno voy a (?:poder )?(?:ayud|respond|contest|atend|dar|proporcion|facilit|hacer|opinar|entrar|generar)",
    r"\bno (?:tengo|tenemos|dispongo|disponemos|cuento)\b (?:de |con |la |el )?(?:capacidad|autorizacion|permiso|permitid|competencia|acceso|informacion|datos|posibilidad|facultad|conocimiento)",
    r"\bno estoy (?:autoriz|capacit|en condiciones|en disposicion|disenad|program|preparad|habilit|facultad|segur[oa] de poder)",
    r"\bno (?:ofrezco|ofrecemos|proporciono|facilito|doy|atiendo|respondo|contesto|genero|valoro|opino)\b",
    r"\b(?:debo|tengo que|prefiero|quisiera|he de|me veo obligad[oa] a) (?:declinar|rechazar|rehusar|abstener|negarme)",
    r"\b(?:prefiero|preferiria|debo|he de) no (?:contest|respond|opinar|pronunci|entrar|atend|dar)",
    r"\bevit(?:are|o|aria) (?:pronunci|respond|contest|opinar|dar|entrar)",
    r"\bme (?:abstengo|abstendre|niego|excuso) (?:de|a)\b",
    r"\b(?:me|nos) (?:impide|impiden|prohibe|prohiben) (?:respond|ayud|generar|dar|contest|atend|ofrec|proporcion|tratar|hablar)",
    r"\b(?:lamento|siento) (?:mucho )?no poder\b",
    r"\b(?:declino|rehuso|rechazo) (?:respond|contest|la (?:solicitud|peticion)|esta (?:solicitud|peticion)|atend)",
    r"\b(?:queda|esta|cae|es algo que queda)(?: todo esto| esto)? fuera de (?:mi|mis|lo que (?:tengo|me|puedo|se me|debo))\b",
    r"\b(?:excede|supera|sobrepasa|rebasa|escapa a) (?:de )?(?:mi|mis|lo que (?:puedo|tengo|me))\b",
    r"\bno (?:me|nos|se me) (?:esta|es|ha sido|permiten?|corresponde|compete|dejan|autorizan?|siento (?:comod|capaz)|resulta posible)\b",
    r"\bno (?:esta|entra|figura) (?:en mi mano|entre mis (?:funciones|capacidades|competencias)|dentro de mis)",
    r"\bmis (?:normas|politicas?|directrices|instrucciones|reglas|limitaciones|principios|pautas)\b.{0,40}\b(?:no|impiden|prohiben|vetan|limitan|restringen)\b",
    r"\bno (?:seria|es|resulta|veo) (?:apropiad|adecuad|prudente|responsable|correct|conveniente)[oa]? que (?:yo|responda|conteste|te|opine|de)\b",
    r"\bno (?:abordo|trato|comento|contestare|respondere|atendere|opinare|entrare|hablare|participare|generare|facilitare|dare|ayudare)\b",
    r"\btendre que (?:declinar|rechazar|dejarlo|abstenerme)|\bdeclinare\b|\brehusare\b",
    # English
    r"\b(?:i|we) (?:can ?not|can t|cant|am unable|m unable|are unable|am not able|m not able|won t|will not|must decline|have to decline|decline|refuse|would rather not|d rather not|do not have (?:access|permission|the ability)|don t have (?:access|permission|the ability)|am not allowed|m not allowed|am not authori[sz]ed)\b",
    # French
    r"\bje (?:ne peux|ne puis|ne suis pas (?:en mesure|autoris|capable)|dois decliner|prefere ne pas|refuse|ne dispose pas|m abstien|regrette de ne pas)",
    r"\bil m est impossible\b",
    # Portuguese
    r"\bnao (?:posso|poderei|me e possivel|consigo|estou autoriz|tenho (?:capacidade|permissao|autorizacao)|disponho|ofereco)\b|\b(?:devo|tenho de|prefiro) (?:recusar|declinar|nao responder)",
    # Catalan
    r"\bno (?:puc|podre|m es possible|estic autoritz|tinc (?:capacitat|permis|autoritzacio)|disposo|ofereixo)\b|\b(?:he de|haig de|prefereixo) (?:declinar|rebutjar|no respondre)",
    # German
    r"\bich (?:kann|darf|mochte|werde) (?:\w+ ){0,6}nicht\b|\bich muss (?:\w+ ){0,3}ablehnen",
]
# Turns of phrase around a refusal, folded; several of them in a short text are one too.
REFUSAL_CUES = [
    r"\blamentablemente\b|\blamento\b|\blo siento\b|\bdisculpa|\bperdona|\bme temo\b|\bdesafortunadamente\b|\bpor desgracia\b|\bsorry\b|\bunfortunately\b|\bdesole\b|\bmalheureusement\b|\binfelizmente\b|\bdesculp|\bleider\b|\bem sap greu\b",
    r"\bmodelo de lenguaje\b|\basistente virtual\b|\binteligencia artificial\b|\bas an ai\b|\blanguage model\b|\bmodele de langage\b",
    r"\bpermitid|\bautoriza|\bnormas de uso\b|\bpolitica|\bdirectrices\b|\bguidelines\b|\bpolicy\b|\brestring|\bprohib",
    r"\b(?:esta|tu|esa|la) (?:peticion|solicitud|consulta|pregunta|cuestion)\b|\bestas cuestiones\b|\beste (?:tema|contenido|asunto|tipo de)\b|\bal respecto\b",
    r"\b(?:un|a un|con un) (?:profesional|especialista|experto|abogado|medico)\b|\bpuedes dirigirte\b|\bte recomiendo acudir\b|\bespero que lo comprendas\b|\bgracias por (?:tu|su) (?:consulta|comprension)\b|\bentiendo tu interes\b|\botra cosa en la que pueda\b",
    r"\b(?:te|le|os|les) (?:recomiendo|sugiero|aconsejo|invito|animo|agradezco)\b|\brecomiendo (?:acudir|consultar|contactar)|\b(?:puedes|puede|podrias|podria) (?:consultar|acudir|contactar|recurrir|preguntar)|\bno dudes? en\b|\bestoy aqui\b|\bestare (?:encantad|dispuest)|\bcon (?:mucho )?gusto\b|\ba tu disposicion\b|\ba su disposicion\b|\bsi (?:tienes|tiene|necesitas|necesita|deseas|quieres) (?:otra|otro|alguna|algun|cualquier|mas)|\bespero que (?:lo |puedas|encuentres|entiendas)|\b(?:entiendo|comprendo) (?:tu|su|que|la|el)\b|\bgracias por\b|\bagradezco\b|\b(?:un )?(?:cordial )?saludo\b",
    r"\bi (?:understand|recommend|suggest|apologi[sz]e|appreciate|hope)\b|\bplease (?:consult|contact|reach out|feel free)\b|\bfeel free\b|\bhappy to help\b|\bthank you\b|\bif you (?:have|need) (?:any|other|another)\b",
    r"\bno (?:\w+ ){0,2}(?:ayudar|responder|contestar|tratar|atender|opinar|ofrecer|dar|valorar|generar)|\bdeclin|\babsten|\brehus|\brechaz|\bfuera de\b|\bimposible\b",
]
_CUES = [re.compile(x) for x in REFUSAL_CUES]
_REFUSAL = re.compile("|".join(f"(?:{x})" for x in REFUSALS))
#: Share of a refusal's words in sentences that decline, excuse or refer elsewhere; less is asked where the answer opens by declining.
REFUSING, REFUSING_FIRST = 0.5, 0.4

# Function words by language, folded.
LANGUAGE_WORDS = {
    "es": """el la los las de del que y en un una unas unos por con para se su sus es al lo como segun fue pero mas sin sobre este esta
        desde hasta cuando donde entre tambien son han ha o si no ante cada cuanto cual cuales porque durante hoy muy asi debe deben
        a dos e quien puede pueden tienen tiene hacia otra otras otros""",
    "en": """the of and to in that was were is for on by with had been their it this these from as at an be are which not have has who
        after before under above between because although when where would should could than there they into once while no its please""",
    "fr": """le la les de du des et un une est dans par pour que qui au aux en sur malgre selon cette ce ces son sa ses a ete plus pas ne
        il elle nous vous sont sera avec chez mais ou ont cela dont leur tout bien d l n s qu quelques e comment pourquoi quelle quel""",
    "pt": """o a os as de do da dos das que e em um uma por com para se nao foi ao na no nas nos pelo pela mais como foram sao sera
        segundo apesar ate isso esta este seu sua pelos depois quando onde mas tambem ja ou muito poucas desde qual quais porque quanto""",
    "ca": """el la els les de del dels que i en un una per amb va van ser es al als mes aquest aquesta segons pel pels no ha han fins des
        seva seu tot tots perque quan on pero amb l d s n hi ho son sera molt any a e o com qui quin quina desde""",
    "de": """der die das und in den von zu mit sich des auf fur ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird
        bei einer um am sind noch wie einem uber so zum war haben nur oder aber vor zur bis mehr durch laut wurde denn dies trotz""",
    "it": """il lo la i gli le di del della dei delle che e in un una per con su non si da al alla sono e stato come piu anche questo
        questa nel nella ma dal dalla ha hanno secondo dopo prima quando a o quale perche""",
}
# Verbs that open a request, by language, folded.
REQUEST_WORDS = {
    "es": "explica explique describe describa resume resuma redacta redacte enumera enumere indica indique compara compare escribe escriba responde responda contesta traduce traduzca cuenta dime dame haz",
    "en": "explain describe summarize summarise write list indicate compare answer translate tell give draft",
    "fr": "resume expliquez explique decrivez decris resumez redigez redige enumerez indiquez comparez ecrivez ecris repondez traduisez racontez donnez",
    "pt": "explique descreva resuma redija enumere indique compare escreva responda traduza conte diga",
    "ca": "explica descriu resumeix redacta enumera indica compara escriu respon contesta tradueix digues",
    "de": "erklare beschreibe fasse nenne vergleiche schreibe beantworte ubersetze erzahle",
    "it": "spiega descrivi riassumi redigi elenca indica confronta scrivi rispondi traduci racconta",
}
# Signs and word endings that only one of these languages writes.
CUES = [("¿", "es"), ("¡", "es"), ("ción ", "es"), ("ciones ", "es"), ("ção ", "pt"), ("ções ", "pt"), ("ões ", "pt"), ("l·l", "ca"), ("ció ", "ca"), ("ß", "de"), ("ung ", "de"), ("zione ", "it"), ("ê", "fr"), ("œ", "fr"), ("ing ", "en"), ("ght", "en")]
_SETS = {k: frozenset(f"{v} {REQUEST_WORDS[k]}".split()) for k, v in LANGUAGE_WORDS.items()}
_OWNERS: dict[str, list[str]] = {}
for _k, _v in _SETS.items():
    for _w in _v:
        _OWNERS.setdefault(_w, []).append(_k)

# How a language is named when an answer in it is asked for, folded.
ASKED = {
    "es": r"espanol|castellano|spanish|espagnol|espanhol|castella|spanisch",
    "en": r"ingles|english|anglais|angles|englisch",
    "fr": r"frances|french|francais|franzosisch",
    "pt": r"portugues|portuguese|portugais|portugiesisch",
    "ca": r"catalan|catala|catalao|valenciano",
    "de": r"aleman|german|allemand|alemao|alemany|deutsch",
    "it": r"italiano|italian|italien|italia",
}
_ASK = re.compile(
    r"\b(?:traduc\w*|traduz\w*|translat\w*|trad\w*|escrib\w*|escrev\w*|escriu\w*|write|ecri\w*|redact\w*|redig\w*|respond\w*|contest\w*|answer|reply|repond\w*|resum\w*|summari\w*|pasa\w*|passa\w*|pon\w*|vierte|explica\w*|explain|dime|di|schreib\w*|ubersetz\w*)\b"
    r"(?:\W+\w+){0,6}?\W+(?:al?|en|in|into|to|em|para o|auf|ins|au|vers l|vers le|del? espanol al)\W+(?:idioma |lengua |el |la |le |l )?(?:" + "|".join(f"(?P<{k}>(?:{v})\\b)" for k, v in ASKED.items()) + ")"
)

_QUOTED = re.compile(r"«[^»]*»|“[^”]*”|\"[^\"]*\"")
_MARKUP = re.compile(r"<\|[^|>]*\|>|</?[a-zA-Z][^>]*>|&nbsp;|[\u200b\u200c\u200d\u2060\ufeff]")
_LABEL = frozenset("pregunta preguntas question pregunto prompt consulta me te preguntaba preguntabas user usuario tu su la el instruccion enunciado planteas you asked the vous demandez repito repite repitiendo dices".split())
# Words of courtesy before what is given back, folded.
_COURTESY = frozenset("claro si por supuesto desde luego aqui tienes tiene va con gusto mucho encantado vale sure of course certainly here is okay ok bien sur voici d accord claro que com certeza es clar i tant".split())
_STOP = re.compile(r"[.!?…][\"»”’'\)\]\}*_`]*$")
_MARKER = re.compile(r"^\s*(?:[-*•–]|\(?\d{1,3}[.)º]|\(?[a-z][.)]|#+)\s*$")
_ITEM = re.compile(r"^\s*(?:[-*•–]|\(?\d{1,3}[.)]|\(?[a-z]\))\s+\S")
_SENTENCES = re.compile(r"[.!?…\n]+")
_SENTENCE = re.compile(r"([^\W_]+)[.!?…][\"»”’'\)\]]*\s+\S")
_BARE = re.compile(r"[\s*_`~#>|]+$")


def is_empty(response: str | None) -> bool:
    """Null, blank, or nothing but markup, punctuation, placeholders and role labels."""
    if response is None:
        return True
    found = words(_MARKUP.sub(" ", response))
    if not found:
        return not any(c.isalnum() for c in _MARKUP.sub(" ", response))
    if found[0] not in _OPENERS:
        return False
    left = _PHRASES.sub(" ", " ".join(found)).split()
    return all(w in PLACEHOLDERS for w in left)


#: Bytes that a copy may leave beyond what the prompt itself does, for each so many characters, and the share of the prompt it may leave out, both compressed.
COPY_BYTES, COPY_CHARS, COPY_REST = 16, 16_384, 0.5


def _compressor(dictionary: str | None = None) -> zstandard.ZstdCompressor:
    options = {"level": 3, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
    if dictionary is not None:
        options["dict_data"] = zstandard.ZstdCompressionDict(dictionary.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(**options)


class Copies:
    """How much of a response its prompt doesn't already hold, by compression."""

    def __init__(self) -> None:
        self.prompt: str | None = None
        self.plain = _compressor()

    def _size(self, text: str, compressor: zstandard.ZstdCompressor | None = None) -> int:
        return len((compressor or self.plain).compress(text.encode()))

    def novelty(self, prompt: str, response: str) -> int:
        """Compressed bytes of the response with the prompt as dictionary, beyond those of the prompt itself."""
        if prompt != self.prompt:
            self.prompt, self.helped, self.alone = prompt, _compressor(prompt), self._size(prompt)
            self.least = self._size(prompt, self.helped)
        return self._size(response, self.helped) - self.least

    def left_out(self, prompt: str, response: str) -> float:
        """Share of the prompt that the response doesn't hold: its compressed size with the response as dictionary, to that without."""
        empty = self._size("")
        return max(0, self._size(prompt, _compressor(response)) - empty) / max(1, self._size(prompt) - empty)

    def is_copy(self, prompt: str | None, response: str) -> bool:
        """Gives back the prompt or most of it, perhaps under a label or after a word of courtesy, with no word of its own."""
        if not prompt:
            return False
        p, r = words(prompt), words(response)
        if len(r) < 3 or len(p) < 3:
            return False
        opening = next((i for i, w in enumerate(r) if w not in _COURTESY), len(r))
        said = [w for w in r[opening:] if w not in _LABEL]
        whole, given = " ".join(p), " ".join(said)
        if not said or self.novelty(whole, given) > COPY_BYTES * (1 + len(given) // COPY_CHARS):
            return False
        have = set(p)
        return all(w in have for w in said) and self.left_out(" ".join(w for w in p if w not in _LABEL), given) <= COPY_REST


def is_refusal(response: str) -> bool:
    """Declines: a phrase of the refusal dictionary, and most words in sentences that decline, excuse or refer elsewhere, however many they are."""
    plain = " ".join(words(response))
    if not _REFUSAL.search(plain) and not _CUES[5].search(plain):
        return False
    total = declining = around = 0
    first: bool | None = None
    seen: set[int] = set()
    for sentence in _SENTENCES.split(response):
        found = words(sentence)
        if not found:
            continue
        plain = " ".join(found)
        total += len(found)
        cues = {i for i, x in enumerate(_CUES) if x.search(plain)}
        seen |= cues
        if _REFUSAL.search(plain):
            declining += len(found)
            first = first is None
        elif cues:
            around += len(found)
            first = first if first is not None else (None if len(found) <= 8 else False)
        elif len(found) > 3 and first is None:
            first = False
    share = (declining + around) / total if total else 0.0
    if declining:
        return share >= (REFUSING_FIRST if first else REFUSING)
    return len(seen) >= 3 and 5 in seen and share >= 0.9


def language(text: str | None, least: float = 2.0) -> str | None:
    """Language of a text by its frequent words, each shared out among the languages that have it; null if unclear."""
    if not text:
        return None
    score = dict.fromkeys(_SETS, 0.0)
    for cue, k in CUES:
        if cue in text:
            score[k] += 1.0
    for w in words(text):
        owners = _OWNERS.get(w)
        if owners:
            share = 1.0 / len(owners) ** 1.5
            for k in owners:
                score[k] += share
    (best, first), (_, second) = sorted(score.items(), key=lambda x: -x[1])[:2]
    return best if first >= least and first >= 1.25 * second else None


def _asked(prompt: str) -> str | None:
    """Language of the last request in a prompt; what a request's own clause brings in by a colon is material, up to the end of its paragraph or of the next."""
    last, material = None, False
    for part in filter(str.strip, prompt.splitlines()):
        if material:
            material = False
            continue
        for colon in re.finditer(":", part):
            if _ASK.search(" ".join(words(re.split(r"[.!?…]\s", part[: colon.start()])[-1]))):
                material = not part[colon.end() :].strip()
                part = part[: colon.start()]
                break
        for m in _ASK.finditer(" ".join(words(part))):
            last = m.lastgroup
    return last


@lru_cache(maxsize=512)
def expected_language(prompt: str | None) -> str | None:
    """Language that the prompt asks an answer in, or else is written in.

    The whole prompt is searched. Quoted material counts only if nothing
    outside it asks, and of several requests the last.
    """
    if not prompt:
        return None
    return _asked(_QUOTED.sub(" ", prompt)) or _asked(prompt) or language(prompt, 0.8)


def is_truncated(response: str, ends: Endings | None = None) -> bool:
    """Breaks off inside a word, sentence or list.

    ``ends``: the model of contexts that end a sentence or an item. It
    decides where the form leaves it open: short answers and lists without
    stops.
    """
    text = _BARE.sub("", _MARKUP.sub(" ", response).rstrip())
    if not text:
        return False
    lines = [x for x in text.splitlines() if x.strip()]
    last = lines[-1]
    if _MARKER.match(last) and len(lines) > 1:
        return True
    if re.search(r"(?:\.\.\.|…)[\"»”’'\)]*$", text):
        return True
    found = words(last)
    if _STOP.search(text):
        return bool(found) and text.endswith(".") and last[:-1].split()[-1].lstrip("(«\"").lower() in ABBREVIATIONS - {"uu", "a", "etc"}
    if text[-1] in ",;:([{«¿¡/-–—\\=+&" or (text[-1] == ":"):
        return True
    prose = any("\n" in m.group() and not m.group(1).isdigit() or m.group(1).lower() not in ABBREVIATIONS and not (len(m.group(1)) == 1) and not (m.group(1).isdigit() and m.start(1) == text.rfind("\n", 0, m.start(1)) + 1) for m in _SENTENCE.finditer(text))
    if prose:
        return True
    if text[-1] in "»”\")]}" or not found:
        return False
    share = 1.0 if ends is None else ends.share(list(found[-2:]))
    items = sum(1 for x in lines if _ITEM.match(x))
    if items >= 2 and _ITEM.match(last):
        return share < 0.02
    return len(words(text)) > 14 or share < 0.01


_NUMBER = re.compile(r"\d+")
_PART_END = re.compile(r"[.!?…]|\n\s*(?=[-*•–]|\d{1,3}[.)])")


def _contexts(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """By word, a hash of it and the word before it in its sentence or item."""
    before = np.concatenate([np.zeros(1, dtype=np.uint64), h[:-1]]) if len(h) else h
    return mix(np.where(first, np.uint64(0), before) * np.uint64(0x9E3779B97F4A7C15) + h)


class Endings:
    """Terminal-context model: how often a word, and a word after the one before it, ends a sentence or an item.

    Two tables of fixed size, filled from all responses. A pair of words
    counts by its own occurrences as far as there are any, and else by those
    of its last word.
    """

    BITS = (18, 20)
    #: Occurrences of a word that weigh as much as those of any word, and of a pair that weigh as much as those of its last word. Numbers are one word.
    PRIORS = (20.0, 200.0)

    def __init__(self, counts: list[tuple[np.ndarray, np.ndarray]]):
        self.counts = counts
        self.base = float(counts[0][1].sum() / max(1.0, counts[0][0].sum()))

    def share(self, last: list[str]) -> float:
        """Share of the other occurrences of the last word, after the one before it, that end something."""
        h, _ = word_hashes([_NUMBER.sub("0", " ".join(last))])
        first = np.zeros(len(h), dtype=bool)
        first[0] = True
        share = self.base
        for x, bits, (n, e), prior in zip((h[-1], _contexts(h, first)[-1]), self.BITS, self.counts, self.PRIORS):
            at = int(x >> np.uint64(64 - bits))
            others, ended = max(0.0, float(n[at]) - 1), max(0.0, float(e[at]) - 1)  # but for the one in question
            share = (ended + prior * share) / (others + prior)
        return share


def endings(responses: DataFrame, column: str = "response") -> Endings:
    """The terminal-context model of all responses, whose bare ends count as ends."""
    sizes = [1 << b for b in Endings.BITS]

    def run(batch: dict[str, list]) -> dict[str, list]:
        parts = [part for text in batch[column] for part in _PART_END.split(_NUMBER.sub("0", text))]
        h, n = word_hashes(parts)
        last = np.zeros(len(h), dtype=bool)
        first = np.zeros(len(h), dtype=bool)
        ends = np.cumsum(n)
        some = n > 0
        last[ends[some] - 1] = True
        first[(ends - n)[some]] = True
        out: dict[str, list] = {"t": [], "b": [], "n": [], "e": []}
        for t, (x, size) in enumerate(zip((h, _contexts(h, first)), sizes)):
            b = (x >> np.uint64(64 - Endings.BITS[t])).astype(np.int64)
            count, ended = np.bincount(b, minlength=size), np.bincount(b[last], minlength=size)
            at = np.nonzero(count)[0]
            out["t"] += [t] * len(at)
            out["b"] += at.tolist()
            out["n"] += count[at].tolist()
            out["e"] += ended[at].tolist()
        return out

    table = map_rows(responses.where(F.col(column).isNotNull()).select(column), run, "t int, b int, n bigint, e bigint")
    got = table.groupBy("t", "b").agg(F.sum("n").alias("n"), F.sum("e").alias("e")).toArrow()
    t, b, n, e = (got[c].to_numpy() for c in ("t", "b", "n", "e"))
    counts = []
    for k, size in enumerate(sizes):
        pair = np.zeros(size, dtype=np.float32), np.zeros(size, dtype=np.float32)
        for into, values in zip(pair, (n, e)):
            into[b[t == k]] = values[t == k]
        counts.append(pair)
    return Endings(counts)


def defect(prompt: str | None, response: str | None, copies: Copies, ends: Endings | None = None) -> str | None:
    """The one defect of a pair, or none."""
    if is_empty(response):
        return "empty"
    if copies.is_copy(prompt, response):
        return "copy"
    if is_refusal(response):
        return "refusal"
    said = language(response, 1.5)
    if said is not None:
        wanted = expected_language(prompt)
        if wanted is not None and wanted != said:
            return "language"
    return "truncated" if is_truncated(response, ends) else None


def defects(
    responses: DataFrame,
    *,
    key_columns: tuple[str, str] = ("prompt_id", "model"),
    prompt_column: str = "prompt",
    response_column: str = "response",
    time_column: str = "created_at",
) -> DataFrame:
    """(prompt_id, model, defect) of each pair of prompt and response that has a defect.

    Of a key delivered more than once the latest delivery counts. A null
    response is ``empty``; with a null prompt only defects of the response
    itself are seen; null keys form one key; very long responses are read
    whole; empty tables give an empty result; other columns are ignored.
    """
    types = {f.name: f.dataType.simpleString() for f in responses.schema}
    shared = responses.sparkSession.sparkContext.broadcast(endings(responses, response_column))
    columns = [*key_columns, prompt_column, response_column, time_column]
    names = [*key_columns, "at", "defect"]

    def run(batch: dict[str, list]) -> dict[str, list]:
        copies = Copies()
        found = [defect(p, r, copies, shared.value) for p, r in zip(batch[prompt_column], batch[response_column])]
        return {**{k: batch[k] for k in key_columns}, "at": batch[time_column], "defect": found}

    schema = ", ".join(f"`{k}` {types[k]}" for k in key_columns) + f", at {types[time_column]}, defect string"
    labelled = map_rows(responses.select(*columns), run, schema)
    latest = labelled.groupBy(*key_columns).agg(F.max(F.struct("at", "defect")).alias("r"))
    return latest.select(*key_columns, F.col("r.defect").alias("defect")).where("defect is not null").select(*names[:2], "defect")
