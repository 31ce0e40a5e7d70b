"""How answers decline, in several languages.

A sentence declines if it says that the speaker will or may not do what was
asked, that a rule stands against it, or that the request is turned down. What
it says of arms, grippers and things is no refusal: the speaker must be its
subject, and the verb one of answering.
"""

from __future__ import annotations

import re
from functools import cache, lru_cache

import ahocorasick

# What may be asked of a speaker, and what is asked for.
_TALK = (
    r"(?:help(?! but)|assist|answer|respond|reply|comply|fulfil\w*|oblige|engage|participate|cooperate|collaborate|take part|accommodate|discuss|share|provide|annotate|analy[sz]e|describe|explain|generate|produce|"
    r"write|create|comment|speak|talk|elaborate|advise|get into|go into|go there|go along|look into|weigh in|touch|offer (?:you )?(?:any|an?|that|this|such|the))"
)
_THING = r"(?:requests?|tasks?|questions?|prompts?|quer(?:y|ies)|topics?|subjects?|instructions?|analysis|annotations?|descriptions?|conversation|answers?|responses?|content|information|images?|frames?|episode|kind of \w+|matter)"
_DO = rf"(?:do (?:that|this|so|it|what you)|(?:give|continue|perform|support|handle|complete|process|carry out|proceed|address|satisfy|meet|honou?r|take on|work on|deal with|entertain)\b(?: (?:you|with|to|on|any|an?|this|that|these|those|such|your|the|it|further))*(?: \w+){{0,2}}? {_THING}|give you|proceed(?: (?:with|any)\b| further|\W*$)|continue\W*$)"
_SELF = r"(?:i|we)"
_ADV = r"(?: (?:really|just|simply|respectfully|unfortunately|also|therefore|politely|still|currently|honestly|do|kindly|hereby|would|will|must|have to|need to|am going to|'ll|shall|in good conscience|be able to|be|possibly|want to|wish to|intend to|care to|choose to))*"
_NOT = r"(?:can(?: ?not|'t)|could(?: not|n't)|will not|won't|would(?: not|n't)|do(?: not|n't)|shall not|shan't|may not|must(?: not|n't)|should(?: not|n't)|am not going to|'m not going to|are not going to)"
_SENSE = r"(?!(?: \w+){0,2} (?:see|tell|make out|judge|reach|grasp|lift|move|detect|observe|recogni[sz]e|distinguish|spot)\b)"
_RULES = r"(?:polic(?:y|ies)|guidelines?|rules?|programming|principles?|terms|safety|instructions|filters?|restrictions?|ethics|values|standards|limits)"

_REFRAIN = r"refrain(?= from (?:answer|comment|discuss|shar|provid|respond|describ|giv|speak|talk|help|assist|engag|do)\w*|\W*$)"

ENGLISH = [
    rf"\b(?:told|asked|instructed|advised|programmed|trained|designed|supposed|allowed|permitted) not to (?:{_TALK}|{_DO})\b",
    rf"(?:\bnot|n't) (?:a|an|the|one of the)(?: \w+)? {_THING} (?:that |which )?{_SELF}\b",
    r"(?:\bnot|n't) (?:feel |be )?comfortable\b",
    r"(?:\bnot|n't) (?:think|believe|feel)\b[^.]{0,25}\b(?:right|appropriate|proper|ethical|wise|responsible)\b[^.]{0,15}\b(?:answer|respond|help|assist|provide|share|describe|discuss|continue)\b",
    rf"\b{_SELF}{_ADV} {_NOT}{_ADV} (?:{_TALK}|{_DO})\b",
    rf"\b(?:won't|will not|would not|cannot|can't|not) be (?:able|willing|allowed|permitted|in a position) to (?:{_TALK}|{_DO})\b",
    rf"\b{_SELF}(?:'m| am|'re| are| was| were)(?: \w+)? (?:not able|unable|not allowed|not permitted|not authori[sz]ed|not in a position|not willing|unwilling|not prepared|prohibited|forbidden|barred|not at liberty|not supposed|not comfortable|uncomfortable|declining|refusing|reluctant|programmed not|instructed not|told not|not designed|not programmed){_SENSE}",
    rf"\b{_SELF}(?:'m| am|'re| are) not (?:able|allowed|permitted|authori[sz]ed|in a position|willing|prepared|at liberty|supposed|comfortable|designed|programmed){_SENSE}",
    rf"\b{_SELF}(?:'ll|'d|'m|'re| am| are)?{_ADV}(?: like to| going to)? (?:decline|refuse|abstain|{_REFRAIN}|opt out|bow out|sit (?:this|that|it)(?: one)? out|stay out of|steer clear|keep out of|say no|turn (?:this|that|it|you) down|pass on|pass(?=\W*$)|leave it (?:there|at that)|(?:stop|end|leave it) here)\b",
    rf"\b(?:have to|must|need to|going to|will|'ll|'d like to) (?:respectfully |politely |therefore )?(?:decline|refuse|{_REFRAIN}|pass on|pass(?=\W*$)|abstain|opt out|say no)\b",
    rf"\b{_SELF}(?:'d| would| will)? ?(?:rather|sooner|prefer|better|choose|chose|elect)(?: to)? not\b|\bprefer not to\b|\brather not\b",
    rf"\bagainst (?:my|our|the|its|company|all my)(?: \w+){{0,2}} {_RULES}\b|\b(?:violat\w+|breach\w*|contrar\w+ to|conflicts? with|under|due to|because of) (?:my|our|the|company|content|usage)(?: \w+){{0,2}} {_RULES}\b",
    rf"\b{_RULES} (?:forbid|forbids|prohibit|prohibits|prevent|prevents|bar|bars|stop|stops|keep|keeps|do not|don't|does not|doesn't|won't|will not|block|blocks|restrict|restricts)\b|\b(?:declined|blocked|denied|refused|prevented|stopped|filtered|restricted|removed) (?:by|under|because of|due to) (?:the |our |my |a )?(?:\w+ )?{_RULES}\b",
    rf"\b{_THING} (?:was|is|has been|have been|must be|will be|had to be)(?: \w+)? (?:declined|denied|refused|blocked|rejected|off[- ]limits|disallowed|prohibited|forbidden|withheld|not allowed|not permitted|not possible|inappropriate|unavailable)\b",
    rf"\b{_THING} (?:cannot|can not|can't|could not|will not|won't) be (?:\w+ )?(?:fulfilled|answered|completed|processed|provided|given|produced|granted|shared|generated|accommodated|met|displayed|shown)\b",
    r"\b(?:that|this|it)(?:'s| is| would be| lies| falls| goes)(?: \w+){0,2} (?:off[- ]limits|out of bounds|a no from me|not possible for me|beyond me|not for me|not my place|none of my business|not something (?:that )?(?:i|we)|something (?:that )?(?:i|we) (?:can't|cannot|won't|will not|don't|do not|must not|may not))\b|\bnot something (?:that )?(?:i|we) (?:will|can|could|am|are|would|do|'m|may|talk|discuss)\b",
    r"\b(?:prevents?|stops?|keeps?|forbids?|bars?) (?:me|us) (?:from|to)\b|\b(?:do not|don't|does not|doesn't|won't|not) (?:allow|permit|let|enable) (?:me|us)\b|\bmay not talk\b|\bnothing to say\b",
    r"\b(?:beyond|outside|out of|not within|exceeds?|past) (?:of )?(?:what i(?:'m| am| can| may)|(?:my|our) (?:\w+ )?(?:scope|remit|abilit\w+|capabilit\w+|permissions?|role|purview|competence|limits|guidelines))",
    r"\b(?:would|will|is)(?: not|n't) (?:be )?(?:appropriate|right|responsible|proper|ethical|suitable|okay|acceptable) (?:for me|to (?:answer|help|provide|share|describe|continue|do|assist|respond))|\bwould(?: not|n't) be (?:appropriate|right|responsible|proper|ethical|suitable)\b|\b(?:irresponsible|inappropriate|unethical|wrong) (?:of me |for me )?to (?:answer|help|provide|share|describe|assist|respond)\b|\b(?:could|may|might) be used to (?:cause |do )?harm\b",
    r"\b(?:ask|find|consult|contact|turn to|look for|need|try) (?:someone|somebody|anyone) else\b|\bask(?:ing)? elsewhere\b|\blook elsewhere\b|\b(?:talk|speak) about something else\b|\bchange the (?:subject|topic)\b",
    r"\bas an? (?:ai|artificial intelligence|language model|large language model|assistant|machine|bot|chatbot)\b[^.]*\b(?:not|cannot|can't|unable|decline|must|won't|don't|no)\b",
    r"\b(?:sorry|apolog\w+|regret\w*|afraid|forgive me|excuse me)\b[^.]{0,60}\b(?:i|we|that|this|it)\b[^.]{0,12}\b(?:can't|cannot|can not|unable|not able|won't|will not|isn't possible|is not possible|not possible|off[- ]limits|not allowed|not something|impossible|have to pass|must pass)\b" + _SENSE,
    r"^\W*(?:(?:sorry|no|nope|apologies|my apologies|regrettably|unfortunately)\W+)*(?:no comment|count me out|off[- ]limits|not happening|absolutely not|no can do|no way|no deal|(?:that's|it's|that is) a (?:hard )?no(?: from me)?|(?:request |access )?(?:denied|blocked|refused|rejected|declined)|i (?:won't|can't|cannot|can not|refuse|decline|pass|must pass|will pass|respectfully decline)|i'll pass|not going to|nope|not for me|out of bounds|not allowed|not permitted|sorry)\W*$",
]
OTHERS = [
    # German, Dutch, Danish, Swedish
    r"\b(?:ich|wir|mir|uns)\b[^.!?]{0,60}\b(?:nicht|keine\w*)\b[^.!?]{0,50}\b(?:\w*helfen|\w*antworten|unterstützen|nachkommen|erfüllen|beschreiben|anbieten|dienen|liefern|geben|erlaubt|gestattet|möglich|äußern|bearbeiten|behilflich|analysieren|erstellen|tun|machen)\b|\bich (?:lehne|verweigere|weigere|verzichte|enthalte|muss (?:leider )?(?:ablehnen|passen))\b|\b(?:ablehnen|verweigern)\b|\bgegen meine\b|\bmeine (?:richtlinien|regeln|vorgaben)\b|\blieber nicht\b|\bkein kommentar\b",
    r"\b(?:ik|we|wij)\b[^.!?]{0,40}\b(?:niet|geen)\b[^.!?]{0,40}\b(?:helpen|antwoorden|beantwoorden|voldoen|beschrijven|geven|doen|toegestaan|mogelijk|uitvoeren)\b|\bik (?:weiger|wijs)\b|\btegen mijn\b|\bliever niet\b",
    r"\b(?:jeg|jag|vi)\b[^.!?]{0,30}\b(?:ikke|ikkje|inte)\b[^.!?]{0,40}\b(?:hjelpe|hjælpe|hjälpa|svare|svara|bistå|besvare|besvara|beskrive|beskriva|gøre|göra)\b|\b(?:jeg|jag) (?:afslår|avslår|vägrar|nægter)\b",
    # French
    r"\b(?:je|nous)\s(?:ne |n'|n’)[^.!?]{0,25}(?:peux|puis|pouvons|pourrai|veux|saurais|souhaite|suis)\b[^.!?]{0,50}(?:aider|répondre|fournir|satisfaire|donner|traiter|décrire|faire|en mesure|autorisée?|capable|commenter|analyser|produire)|\bje (?:refuse|décline|dois (?:refuser|décliner)|préfère ne pas|préfère m'abstenir|regrette|m'abstiens)\b|\bcontraires? à (?:mes|nos)\b|\b(?:désolée?|navrée?|malheureusement)\b[^.!?]{0,60}\b(?:je|nous|impossible|m'est)\b[^.!?]{0,40}\b(?:ne|n'|n’|impossible|pas)\b|\bm'est impossible\b|\bpas de commentaire\b|\bmes (?:règles|directives|consignes)\b",
    # Spanish, Portuguese, Italian
    r"\bno (?:puedo|podemos|podré|quiero|voy a|debo|me es posible|me está permitido|estoy autorizad\w|estoy en condiciones|soy capaz de)\b[^.!?]{0,40}\b(?:ayudar\w*|responder\w*|contestar\w*|proporcionar\w*|cumplir|hacer|atender|ofrecer\w*|describir\w*|analizar\w*|continuar|dar\w*|generar|comentar|hablar)\b|\bno (?:me es posible|me está permitido|estoy autorizad\w)|\b(?:me niego|debo (?:negarme|declinar|rechazar)|tengo que (?:negarme|declinar|rechazar)|prefiero no|rechazo|declino)\b|\bcontra (?:de )?mis\b|\bsin comentarios\b|\b(?:lo siento|lamento|lamentablemente|disculpa)\b[^.!?]{0,50}\bno (?:puedo|podemos|es posible|me)\b",
    r"\bnão (?:posso|podemos|poderei|consigo|quero|vou|estou autorizad\w|me é permitido)\b[^.!?]{0,40}\b(?:ajudar\w*|responder\w*|fornecer\w*|atender|cumprir|fazer|descrever\w*|analisar\w*|continuar|dar|gerar|comentar)\b|\b(?:recuso\w*|prefiro não|devo recusar|tenho de recusar)\b|\bcontra as minhas\b|\b(?:desculpe|lamento|infelizmente|sinto muito)\b[^.!?]{0,50}\bnão (?:posso|podemos|é possível|me)\b",
    r"\bnon (?:posso|possiamo|potrò|voglio|intendo|sono (?:in grado|autorizzat\w)|mi è (?:possibile|permesso|consentito))\b[^.!?]{0,40}(?:\b(?:aiutar\w*|risponder\w*|fornir\w*|soddisfar\w*|far\w*|descriver\w*|analizzar\w*|continuar\w*|dar\w*|generar\w*|commentar\w*)\b|$)|\b(?:mi rifiuto|devo rifiutar\w*|preferisco non|declino|rifiuto di)\b|\bcontro le mie\b|\b(?:mi dispiace|purtroppo|spiacente)\b[^.!?]{0,50}\bnon (?:posso|possiamo|è possibile|mi)\b|\bnessun commento\b",
    # Polish, Russian, Japanese, Chinese, Korean, Arabic
    r"\bnie (?:mogę|możemy|będę|chcę|wolno mi)\b[^.!?]{0,40}\b(?:pomóc|odpowiedzieć|udzielić|spełnić|opisać|zrobić)\b|\bodmawiam\b|\bmuszę odmówić\b",
    r"\bне (?:могу|можем|буду|смогу|хочу|вправе|имею права)\b[^.!?]{0,40}(?:помочь|помогать|ответить|отвечать|выполнить|предоставить|описать|обсуждать|сделать|дать)|(?:вынужден\w* отказ|отказываюсь|не в состоянии помочь|против моих|без комментариев)",
    r"(?:お答え|お手伝い|回答|対応|提供|お力|お応え|ご案内|ご要望)[^。]{0,14}(?:でき(?:ません|かねます)|いたしかねます|しかねます)|お断り|応じられません|控えさせて",
    r"(?:无法|不能|不可以|没办法|不便)[^。]{0,12}(?:回答|协助|帮助|提供|满足|处理|讨论|评论)|拒绝(?:回答|提供)|無法(?:回答|提供|協助)",
    r"(?:도와|답변|대답|제공)[^.]{0,12}(?:수 없습니다|수 없어요|어렵습니다)|거절|(?:لا أستطيع|لا يمكنني|لن أتمكن)[^.]{0,30}(?:مساعد|الإجابة|تقديم|تلبية)|أعتذر",
]
_ENGLISH = re.compile("|".join(ENGLISH), re.I)
_OTHERS = re.compile("|".join(OTHERS), re.I)
# What every refusal has some of, in English and in other languages. A sentence is looked through for all of them at once.
_TRIGGERS = {
    "english": (
        "n't|cannot|can not| not |unable|declin|refus|abstain|refrain|opt out|bow out|sit this|sit that|sit it|steer clear|stay out|keep out|say no|turn this|turn that|turn it|turn you| pass|leave it|stop it here|end it here|"
        "stop here|end here|prohibit|forbid|barred|uncomfortable|reluctant|unwilling|rather|sooner|prefer| chose|choose|elect|polic|guideline|programming|principle| terms|safety|instruction|filter|restrict|ethic| values|standards|"
        "limits|denied|blocked|reject|disallow|withheld|inappropriate|unavailable|out of bounds| no |beyond|outside|out of my|exceed|prevent|stops me|stops us|keeps me|keeps us|bars me|irresponsible|wrong of|wrong to|wrong for|"
        "harm|one else|body else|elsewhere|something else|the subject|the topic|as an ai|as a language|as an artificial|as an assistant|as a large|as a bot|as a chatbot|as a machine|no comment|count me|happening|no way|no deal|nope|"
        "sorry|apolog|regret|afraid|nothing to say|my rules|our rules|the rules| past my|none of my| rules |would not be|would be"
    ),
    "other": " ich | wir | mir | uns |ablehnen|verweiger|gegen meine|meine richtlinien|lieber| kommentar| ik | wij |liever|tegen mijn| jeg | jag | vi | je | nous |commentaire|impossible|puedo|podemos|niego|prefier|rechazo|declino|lament|siento| no |contra|"
    "posso|poderei|consigo|recus|infelizmente|desculpe|possiamo|rifiut|preferisco|dispiace|purtroppo|commento|odmawiam| nie | non |disculpa|sin com",
}


@cache
def _triggers() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for kind, words in _TRIGGERS.items():
        for w in words.split("|"):
            found.add_word(w, found.get(w, frozenset()) | {kind})
    found.make_automaton()
    return found


_COURTESY = re.compile(
    r"\b(?:i hope you understand|anything else|something different|contact a|qualified expert|ask something else|ask me|ask about|thank you|thanks for|apologies|i apologi[sz]e|(?:i'm|i am) sorry|"
    r"let me know|feel free|happy to help|glad to|consult a|reach out|understand(?:ing)?\W*$|be honest|sorry|please (?:try|choose|rephrase|ask)|another (?:question|topic)|"
    r"entschuldigung|tut mir leid|leider|désolée?|merci|lo siento|gracias|disculp\w+|mi dispiace|grazie|desculpe|obrigad\w|извините|простите|申し訳|抱歉|对不起|spasibo)\b",
    re.I,
)


@lru_cache(maxsize=50_000)
def declines(sentence: str) -> bool:
    """Whether a sentence turns the request down."""
    straight = sentence.replace("’", "'")
    kinds = {k for _, ks in _triggers().iter(f" {straight.lower()} ") for k in ks}
    if not sentence.isascii():
        kinds.add("other")
    return bool(("english" in kinds and _ENGLISH.search(straight)) or ("other" in kinds and _OTHERS.search(straight)))


def is_refusal(sentences: list[str], size) -> bool:
    """Whether an answer declines and, courtesies aside, says little else. ``size`` counts the words of sentences."""
    refused = [s for s in sentences if declines(s)]
    if not refused:
        return False
    rest = [s for s in sentences if s not in refused and not _COURTESY.search(s)]
    return size(rest) * 2 <= size(refused)
