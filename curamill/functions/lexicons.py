"""Word lists and patterns the operators share. They decide results and are stated as they are."""

STOP_WORDS = """i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers herself
it its itself they them their theirs themselves what which who whom this that these those am is are was were be been being
have has had having do does did doing a an the and but if or because as until while of at by for with about against between
into through during before after above below to from up down in out on off over under again further then once here there
when where why how all any both each few more most other some such no nor not only own same so than too very s t can will
just don should now""".split()

TRANSITIONS = "however therefore furthermore moreover additionally consequently thus hence nevertheless meanwhile subsequently first second finally also besides".split()
TRANSITION_PHRASES = ["in addition", "for example", "for instance", "in contrast"]
CONCLUSIONS = ["conclusion", "summary", "in conclusion", "to conclude", "finally", "in summary", "to sum up", "overall"]
# Signs of a cut text, as one pattern on lower-cased text.
TRUNCATION = r"\.\.\.\n?\z|continued|see next page|to be continued|\[truncated\]|\(cont\)"

TOPICS = {
    "technology": "software hardware computer digital technology algorithm data system programming code".split(),
    "business": "business company market customer revenue strategy management sales profit enterprise".split(),
    "science": "research study experiment scientific analysis theory hypothesis results findings evidence".split(),
    "health": "health medical patient treatment disease medicine clinical doctor hospital care".split(),
    "education": "education learning student teaching school university course training knowledge study".split(),
    "finance": "finance investment money financial bank credit loan asset portfolio trading".split(),
    "legal": "legal law court regulation compliance contract attorney justice policy rights".split(),
}
QUESTION_TEMPLATES = ["What is %s?", "How does %s work?", "Why is %s important?"]
PATTERN_QUESTIONS = [
    (["how to", "steps"], "What are the steps involved?"),
    (["benefit", "advantage"], "What are the advantages?"),
    (["problem", "issue"], "What problems does this address?"),
    (["example"], "Can you provide examples?"),
]
CODE_MARKS = ["def ", "class ", "function", "()", "{}", ";", "//"]

#: Function words that decide a text's language.
LANGUAGE_WORDS = {
    "en": "the of and to in is that it was for on with as by this are at from".split(),
    "fr": "le la les des du et est une un que qui dans pour sur au avec il nous".split(),
    "de": "der die das und ist ein eine den dem nicht mit für auf wir im von zu sich".split(),
    "es": "el la los las del y es una un que en por para con se al su como".split(),
}

# Blanks that Python's str.strip removes, as one character class both regex engines read alike.
BLANK = r"[\t\n\x{0b}\x{0c}\r\x{1c}-\x{1f} \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
URL = r"https?://(?:[a-zA-Z]|[0-9]|[$-_@.&+]|[!*\\(),]|(?:%[0-9a-fA-F][0-9a-fA-F]))+"
EMAIL = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b"
SOLID = "[^" + BLANK[1:]
CONTROL = r"[\x{00}-\x{08}\x{0b}\x{0c}\x{0e}-\x{1f}\x{7f}-\x{9f}]"
BULLET = r"[•◦▪▫⁃]"
