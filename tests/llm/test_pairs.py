from __future__ import annotations

import datetime as dt

import pytest

from acequia.llm.pairs import Copies, defect, defects, expected_language, is_truncated, language

SCHEMA = "prompt_id bigint, prompt string, response string, model string, created_at timestamp, defect string, at int"
AT = dt.datetime(2024, 1, 1)
Q = "¿Qué plazo tienen los vecinos de Somtejar para recurrir la ordenanza 12?"

CASES = [
    (None, "empty"), ("", "empty"), (" \n", "empty"), ("<p></p>", "empty"), ("(sin respuesta)", "empty"), ("Assistant: ", "empty"), ("N/A", "empty"), ("**", "empty"), ("​", "empty"),
    ("No.", None), ("Sí", None), ("Hasta 5992 euros", None), ("18 de diciembre de 1993", None), ("En Somtejar", None),
    (Q, "copy"), (Q.upper(), "copy"), (f"«{Q}»", "copy"), (f"Me preguntas: {Q[1:]}", "copy"), (f"{Q}\n\n{Q}", "copy"),
    (f"Pregunta: {Q}\nLos vecinos disponen de un mes desde la publicación del anuncio.", None),
    ("Lo siento, pero no puedo ayudarte con esa petición.", "refusal"), ("Hola. Queda fuera de lo que tengo permitido tratar.", "refusal"), ("I'm sorry, but I can't help with that.", "refusal"),
    ("Lo siento por la extensión, pero el caso lo requiere. El plazo es de un mes y se cuenta desde la publicación del anuncio en el tablón.", None),
    ("En Somtejar, la Junta rectora no puede negarse a tramitar la solicitud si consta el artículo 61. El plazo es de un mes.", None),
    ("No es posible responder con un solo plazo: son tres meses en Somtejar y cinco días en el resto.", None),
    ("The council extended the filing period because the earlier record was incomplete and it was in the file.", "language"),
    ("Claro. Le conseil régional a approuvé le barème modifié dans le dossier et cela concerne les foyers de la commune.", "language"),
    ("El plazo es de un mes. La resolución agota la vía administrativa y se remi", "truncated"),
    ("El plazo es de un mes. La resolución agota...", "truncated"),
    ("Los pasos son:\n1. Presentar el recurso en el registro.\n2.", "truncated"),
    ("Los elementos son:\n- El recurso\n- La instancia\n- El poder", None),
    ("El plazo es de un mes conforme al artículo 31 de la ordenanza, y se cuenta desde el anuncio.", None),
]


@pytest.mark.parametrize(("response", "expected"), CASES)
def test_one_pair(response, expected):
    assert defect(Q, response, Copies()) == expected


def test_languages():
    assert language("El plazo es de un mes y se cuenta desde la publicación") == "es"
    assert language("12 34") is None
    assert expected_language("Traduce al inglés: El plazo es de un mes") == "en"
    assert expected_language("Escribe en francés una nota sobre esto: El plazo es de un mes") == "fr"
    assert expected_language("Please summarise the situation of Somtejar in 2023 in a few lines.") == "en"
    assert expected_language(None) is None


def test_asked_language_counts():
    prompt = "Traduce al inglés: La resolución agota la vía administrativa y se remitirá copia."
    assert defect(prompt, "The decision ends the administrative route and a copy will be sent to them.", Copies()) is None
    assert defect(prompt, "El taller de Somtejar empleó cantería en los encargos que se conocen de la villa.", Copies()) == "language"


def test_language_asked_at_the_end_of_a_long_prompt():
    passage = "El taller de Somtejar empleó cantería en los encargos que se conocen de la villa y de su comarca. " * 5
    english = "The workshop of Somtejar used stonework in the orders that are known from the town."
    spanish = "La Junta rectora aprobó las obras de la torre y las pagó con los fondos de los vecinos."
    for prompt in (f"{passage}\n\nResponde en inglés.", f"{passage}Resume lo anterior en inglés", f"Texto: «Se pide que respondas en francés.» {passage}Responde en inglés."):
        assert expected_language(prompt) == "en"
        assert defect(prompt, english, Copies()) is None
        assert defect(prompt, spanish, Copies()) == "language"
    assert expected_language(f"Responde en inglés: {passage}Escribe en francés una carta.") == "en"
    assert expected_language(f"Traduce al inglés:\n{passage}Escribe en francés una carta.") == "en"
    assert expected_language(passage) == "es"


POLITE = "Entiendo tu interés por este asunto y espero que lo comprendas. Te recomiendo acudir a un profesional que conozca bien el caso y pueda revisar contigo toda la documentación antes de dar cualquier paso. También puedes consultar los canales oficiales, donde te darán información actualizada. Si necesitas otra cosa en la que pueda ayudarte, estoy aquí para lo que haga falta. Gracias por tu comprensión y un cordial saludo."


def test_refusals_of_any_length():
    short = "Lo siento, pero no puedo ayudarte con esta solicitud."
    for text in (short, f"{short} {POLITE}", f"{POLITE} {short}", f"{short} {POLITE}" * 4):
        assert defect(Q, text, Copies()) == "refusal"
    answer = "El plazo es de un mes y se cuenta desde la publicación del anuncio en el tablón de la villa. La instancia se presenta en el registro y se resuelve en dos meses. Contra ella cabe recurso ante el pleno."
    assert defect(Q, f"No puedo darte la fecha exacta. {answer}", Copies()) is None


def test_copy_after_a_word_of_courtesy():
    assert defect(Q, f"Claro, {Q}", Copies()) == "copy"
    assert defect(Q, f"Claro, {Q} Sí.", Copies()) is None
    assert defect(Q, f"{Q} " * 3000, Copies()) == "copy"


def test_many_placeholders():
    assert defect(Q, "N/A. " * 50, Copies()) == "empty" and defect(Q, "usuario asistente " * 20, Copies()) == "empty"


def test_short_answer_is_whole():
    assert not is_truncated("El artículo 133 de la ordenanza reguladora")


def test_table(spark):
    later = AT + dt.timedelta(days=1)
    rows = [
        (1, Q, None, "a", AT, "x", 1), (1, Q, None, "a", AT, "x", 1), (2, Q, "Sí", "a", AT, "x", 1), (3, None, "...", None, AT, None, 2),
        (4, Q, "", "b", AT, None, 2), (4, Q, "Sí", "b", later, None, 2), (5, Q, "Los vecinos disponen de un mes. " * 5000 + "La resolución", "c", None, None, 1),
    ]
    found = {tuple(r) for r in defects(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found == {(1, "a", "empty"), (3, None, "empty"), (5, "c", "truncated")}
    assert defects(spark.createDataFrame([], SCHEMA)).count() == 0
