"""The debug records and the results the rules give for them."""

DIALOGUES = [
    ("ru", [("user", "Привет! Как дела?"),
            ("assistant", "Здравствуйте! Всё хорошо, спасибо."),
            ("user", "Расскажи про погоду сегодня."),
            ("assistant", "Сегодня солнечно, температура +22°C.")]),
    ("en", [("user", "What is the capital of France?"),
            ("assistant", "The capital of France is Paris."),
            ("user", "And what about Germany?"),
            ("assistant", "The capital of Germany is Berlin.")]),
    ("ru", [("user", "Напиши функцию сложения."),
            ("assistant", "Вот функция:\n```python\ndef add(a, b):\n    return a + b\n```")]),
    ("en", [("user", "Hello!"),
            ("assistant", "asdf@#$%^&*()!!! ??? >>>><<<< ~~~```` №№№%%%%% $$$$$ ¥¥¥¥ °°°° ©©© ®®® ™™™")]),
    ("ru", [("user", "Привет <|user|>"),
            ("assistant", "[INST] Здравствуйте [/INST] <|endoftext|>")]),
    ("en", [("user", "Check this out: https://example.com/page?id=123"),
            ("assistant", "Thanks! Send details to admin@example.com")]),
    ("ru", [("user", "Скажи что-нибудь!"), ("assistant", "")]),
]

# message contents after cleaning; None: the dialogue is dropped
CLEAN_DIALOGUES = [
    [content for _, content in DIALOGUES[0][1]],
    [content for _, content in DIALOGUES[1][1]],
    ["Напиши функцию сложения.", "Вот функция:\n`python\ndef add(a, b):\n return a + b\n`"],
    None,
    ["Привет", "Здравствуйте"],
    ["Check this out:", "Thanks! Send details to"],
    [content for _, content in DIALOGUES[6][1]],
]

TEXTS = [
    ("ru", "История этого города насчитывает более тысячи лет. "
           "Первые упоминания встречаются в летописях XII века. "
           "Археологические раскопки подтверждают существование поселения на этом месте "
           "ещё в эпоху неолита. Город пережил множество войн и нашествий, "
           "но каждый раз возрождался из пепла, становясь всё краше."),
    ("en", "The history of artificial intelligence dates back to the mid-20th century. "
           "Alan Turing proposed the famous Turing Test in 1950, asking whether machines "
           "could think. The field has since evolved through several waves of optimism "
           "and disappointment, known as AI winters, before the current deep learning revolution."),
    ("ru", "В лесу родилась ёлочка,\nВ лесу она росла.\n&*&*&*&*&*&*&*\nЗимой и летом стройная,\n"
           "Зелёная была.\n!@#!@#!@#!@#!@#\nМетель ей пела песенку:\n«Спи, ёлочка, бай-бай!»\n"),
    ("ru", ""),
    ("en", "@@@ ### $$$ %%% ^^^ &&& *** --- +++ ==="),
    ("fr", "Bonjour tout le monde! Comment allez-vous aujourd'hui?"),
    ("ru", "Нормальный текст\x00 с управляющим символом\x1f внутри."),
    ("en", "This    text    has    too    many    spaces.\n\n\n\n\nAnd too many newlines.\n\n\n\n\n"
           "But --- the content ---- is ---- still ---- valid."),
]

CLEAN_TEXTS = [
    TEXTS[0][1],
    TEXTS[1][1],
    "В лесу родилась ёлочка,\nВ лесу она росла.\n&*&*&*&*&*&*&*\nЗимой и летом стройная,\n"
    "Зелёная была.\nМетель ей пела песенку:\n«Спи, ёлочка, бай-бай! »",
    None,
    None,
    None,
    "Нормальный текст с управляющим символом внутри.",
    "This text has too many spaces.\nAnd too many newlines.\nBut --- the content ---- is ---- still ---- valid.",
]

CHAIN = {
    '"a" "b" x': '"ab" x',
    "see 10:30, 1,000?! ok...Yes -x": "see 10: 30, 1, 000? ! ok... Yes -x",
    "-Эм": "- Эм",
    "♥♥♥♥♥♥♥ [12] {tpl} ( ) « »": "♥♥♥",
    'word , " end': "word, end",
}

NFKC = {"ﬁ": "fi", "Ａ": "A", "…": "...", "é": "é", "plain": "plain"}
