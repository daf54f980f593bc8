"""Fixed vocabularies of the machine-reader classifier.

Everything in this module is a value the results depend on, written out as
plain text.  Phrases are stored the way normalized text looks: lower case, no
accents, single spaces.
"""

from __future__ import annotations

LEXICON_VERSION = 1


def _lines(block: str) -> tuple[str, ...]:
    return tuple(line.strip() for line in block.strip().splitlines())


def _words(block: str) -> tuple[str, ...]:
    return tuple(block.split())


# ---------------------------------------------------------------------------
# Cue phrases, (category, language, phrases).
# ---------------------------------------------------------------------------
CUES: tuple[tuple[str, str, tuple[str, ...]], ...] = (
    ("override", "en", _lines("""
        ignore all previous
        ignore the previous
        ignore previous instruction
        ignore prior instruction
        ignore any previous
        ignore the above
        ignore everything above
        disregard all previous
        disregard the previous
        disregard previous instruction
        disregard prior instruction
        disregard the above
        forget all previous
        forget the previous
        forget your instruction
        override the previous
        override your instruction
        new instructions:
        updated instructions:
        these instructions take precedence
        this supersedes any previous
    """)),
    ("override", "pt", _lines("""
        ignore as instrucoes anteriores
        ignore todas as instrucoes
        ignore as instrucoes acima
        desconsidere as instrucoes
        desconsidere todas as instrucoes
        desconsidere o que foi dito
        esqueca as instrucoes
        novas instrucoes:
        estas instrucoes tem prioridade
    """)),
    ("role-address", "en", _lines("""
        you are an ai
        you are a language model
        you are an assistant
        you are an llm
        as a language model
        as an ai assistant
        as an ai model
        if you are an ai
        if you are a language model
        if you are reading this as an ai
        your system prompt
        the system prompt above
        reveal your system
        print your system
        attention ai
        attention, ai
        note to the ai
        note to ai
        message for the ai
        for ai systems reading
        dear ai
        hey chatgpt
        hello chatgpt
        to the language model reading
    """)),
    ("role-address", "pt", _lines("""
        voce e uma ia
        voce e um assistente
        voce e um modelo de linguagem
        como modelo de linguagem
        seu prompt do sistema
        o prompt do sistema acima
        as instrucoes do sistema acima
        atencao ia
        atencao, ia
        mensagem para a ia
        se voce e uma ia
    """)),
    ("output-coercion", "en", _lines("""
        respond only with
        respond with only
        reply only with
        reply exactly
        output only
        print only
        say only
        you must say
        you must respond
        you must output
        do not mention this
        do not mention that
        do not reveal
        do not disclose this
        without mentioning
        do not summarise this
        do not summarize this
        answer yes to
    """)),
    ("output-coercion", "pt", _lines("""
        responda apenas
        responda somente
        responda exatamente
        diga apenas
        escreva apenas
        nao mencione
        nao revele
        voce deve dizer
        voce deve responder
    """)),
    ("evaluation-coercion", "en", _lines("""
        rate this highly
        rate this candidate
        rate this document
        score this highly
        give this a high
        give it a high score
        recommend this candidate
        recommend this applicant
        strong hire
        excellent candidate
        best candidate
        approve this application
        approve this document
        approve this invoice
        mark this as approved
        mark this as genuine
        mark this as authentic
        treat this as verified
        consider this document authentic
        no risk signals
        10/10
        accept a strong recommendation
    """)),
    ("evaluation-coercion", "pt", _lines("""
        avalie este candidato
        recomende este candidato
        recomende esta candidatura
        de a maior nota
        de nota maxima
        aprove este documento
        aprove esta solicitacao
        considere este documento autentico
        marque como aprovado
        excelente candidato
        melhor candidato
    """)),
    ("exfiltration", "en", _lines("""
        send the following to
        send this to http
        include the following link
        include this link in your
        append the following url
        fetch the url
        visit the following url
        post the results to
        exfiltrate
        make a request to http
        encode it in the url
    """)),
    ("exfiltration", "pt", _lines("""
        envie o seguinte para
        envie os dados para
        inclua o seguinte link
        acesse o endereco
        faca uma requisicao para
    """)),
    ("delimiter-mimicry", "en", _lines("""
        <system>
        </system>
        <|im_start|>
        <|im_end|>
        <|endoftext|>
        <|start_header_id|>
        <|eot_id|>
        [inst]
        [/inst]
        <<sys>>
        <</sys>>
        ### instruction
        ### system
        [system prompt]
        {{system}}
        <system_prompt>
        <|system|>
        <|user|>
        <|assistant|>
    """)),
)

# Verbs that open an instruction, English then Portuguese.
IMPERATIVE_VERBS: tuple[str, ...] = _words("""
    ignore disregard forget respond reply output print say
    write answer rate score recommend approve include
    append send follow execute run act pretend assume
    treat consider remember summarise summarize translate
    list return provide add stop begin start do never
    always must repeat reveal disclose mark classify rank
    desconsidere esqueca responda escreva diga imprima
    avalie recomende aprove inclua envie adicione sempre
    nunca pare comece siga execute finja assuma trate
    considere lembre resuma traduza liste retorne forneca
    classifique marque repita revele
""")

# Second-person words, both languages.
SECOND_PERSON: tuple[str, ...] = _words(
    "you your yours yourself voce voces seu sua seus suas te ti"
)

# Characters that end a clause, and characters that may stand
# between the start of a clause and its first word.
CLAUSE_BREAKS = ".!?;:\n|"
CLAUSE_LEAD = " \"'(["

# Category names.
IMPERATIVE = "imperative-address"
HIGH_CONFIDENCE = ("delimiter-mimicry", "role-address")
CONFIDENT, TENTATIVE = "confident", "tentative"

# The closed set of carriers a text field can come from.
FIELD_KINDS = (
    "info",
    "xmp",
    "annotation",
    "embedded-file",
    "office-properties",
    "office-comment",
    "office-hidden-text",
)


def phrases() -> list[tuple[str, str, str]]:
    """Every cue as ``(category, lang, phrase)``."""
    return [(cat, lang, p) for cat, lang, block in CUES for p in block]


def categories() -> list[str]:
    """Phrase categories, without the imperative one, in table order."""
    return list(dict.fromkeys(cat for cat, _, _ in CUES))
