"""Personal information in free text: where it stands and of which kind.

Five kinds are found: email, phone, id_number, address and name, in English, German,
French, Spanish and Chinese.  A document is read as it stands: characters are
only exchanged one for one (full-width digits, odd hyphens and blanks) before the
search, so that places are those of the text.  Kinds are searched from the most to
the least certain, and what one has taken the next leaves alone.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import ahocorasick
import regex

KINDS = ("email", "id_number", "phone", "address", "name")

# One character for one: full-width forms, hyphens, blanks.
_PLAIN = {0xFF01 + i: 0x21 + i for i in range(94)} | dict.fromkeys([0x2010, 0x2011, 0x2012, 0x2013, 0x2212], ord("-")) | dict.fromkeys([0xA0, 0x2007, 0x2009, 0x202F, 0x3000], ord(" "))

_ODD = re.compile("[\uff01-\uff5e\u2010-\u2013\u2212\u00a0\u2007\u2009\u202f\u3000]")

# --- email ---------------------------------------------------------------------------------------------------------
_AT = r"(?:[ ]?@[ ]?|[ ]?[(\[{]\s?(?:at|AT|At)\s?[)\]}][ ]?|[ ](?:AT)[ ])"
_DOT = r"(?:\.|[ ]?[(\[{]\s?(?:dot|DOT|Dot|punkt|punto|point)\s?[)\]}][ ]?|[ ]DOT[ ])"
_LOCAL, _LABEL = r"[\p{L}\d][\p{L}\d._%+\-]*", r"[\p{L}\d](?:[\p{L}\d\-]*[\p{L}\d])?"
EMAIL = regex.compile(rf"(?<![\p{{Latin}}\d._%+\-])(?:[a-zA-Z\d][a-zA-Z\d._%+\-]*{_AT}[a-zA-Z\d](?:[a-zA-Z\d\-]*[a-zA-Z\d])?(?:{_DOT}[a-zA-Z\d](?:[a-zA-Z\d\-]*[a-zA-Z\d])?)+|{_LOCAL}[ ]at[ ]{_LABEL}(?:[ ]dot[ ]{_LABEL})+)")

#: Where an email may be: an at in any spelling.
_AT_SIGN = regex.compile(r"@|\bAT\b|[(\[{]\s?[aA][tT]\s?[)\]}]|[ ]at[ ](?=\S+[ ]dot[ ])")
#: How far an email may go behind its at.
_DOMAIN = regex.compile(rf"[ ]?[\p{{L}}\d\-]*+(?:(?:{_DOT}|[ ]dot[ ])[\p{{L}}\d\-]*+)*+")

# --- identity numbers ----------------------------------------------------------------------------------------------
# Labels before a person's number.
_ID_LABELS = (
    r"SSN|passport|Reisepass|pasaporte|social security(?: no\.?| number)?|soc\. sec\.(?: no\.?)?|NHS (?:no\.?|number)|(?:national|patient|hospital|insurance|passport|medical record|person(?:al)?) ?(?:ID|no\.|nr\.?|number)|(?:Hosp\.?|chart|hospital|file) (?:no\.?|number)|MRN|\bID"
    r"|Versichertennummer|Versicherten-?Nr\.?|Patienten-?(?:ID|nummer|Nr\.?)|Personalausweis(?:nummer|-?Nr\.?)?|Ausweis(?:nummer|-?Nr\.?)|Reisepass(?:nummer|-?Nr\.?)?|Sozialversicherungsnummer|Fallnummer"
    r"|passeport|n[°º] de (?:sécurité sociale|passeport|patient|dossier)|numéro de (?:sécurité sociale|passeport|patient)|(?:carte d'identité|CNI) n[°º]"
    r"|DNI|NIE|NIF|pasaporte|historia clínica|n[úu]mero de (?:paciente|seguro|pasaporte)|NHC"
    r"|身份证号码?|护照号码?|病历号码?|住院号码?|医保号码?|社保号码?|患者编号"
)
_ID_BODY = r"(?:[A-Z]{1,3}[ /\-]?)?\d\d*(?:[A-Z]{1,3}\d+)?(?:[ /\-]\d+(?:[A-Z]{1,2}\d+)?)*(?:[ \-]?[A-Z](?![\p{Latin}\d]))?"
ID_AFTER_LABEL = regex.compile(rf"(?<![\p{{Latin}}\d])(?:{_ID_LABELS})(?:[ ]?(?:no\.?|nr\.?|number|n[°º]))?(?:[ ](?:is|was|ist|lautet|est|es)(?=[ ]))?[ ]?[:：=#]?[ ]{{0,2}}(?P<id>{_ID_BODY})", regex.IGNORECASE)
ID_BEFORE_LABEL = regex.compile(rf"(?<![\p{{Latin}}\d./\-])(?P<id>{_ID_BODY})(?=[ ]\((?:insurance|passport|patient|NHS|national|social security|SSN)\b)")
_ID_CASE = regex.compile(_ID_BODY)
_LABEL_BEHIND = regex.compile(r"[ ]\((?:insurance|passport|patient|NHS|national|social security|SSN)\b")

# Labels before a number that is no person's.
NO_PERSON = regex.compile(r"\b(?:lots?|kits?|order no\.|order|trial|EC approval|approval|batch|build|catalog(?:ue)? no\.|PMID|GSE|GSM|GPL|SRX|PRJ|slide|row|Room|box|shelf|version)[ \-:.]{0,2}[A-Z]?[\-]?\d[\d \-/]*\d")

# --- phones --------------------------------------------------------------------------------------------------------
_SEP = r"[ .\-/]{1,2}"
PHONE_COUNTRY = regex.compile(r"(?<![\p{Latin}\d])(?:\(\+\d{1,3}\)|\+\d{1,3}|00[1-9]\d)(?:[ .\-/]{0,2}\(\d{1,4}\))?(?:[ .\-/]{0,2}\d{1,11}){1,6}")
PHONE_PLAIN = regex.compile(
    rf"(?<![\p{{Latin}}\d+./\-]|\d[ ])(?:\(0\d{{1,4}}\)[ ]{{0,2}}\d{{3,8}}(?:{_SEP}\d{{2,6}}){{0,3}}"
    rf"|0\d(?:[ .\-]\d{{2}}){{4}}"
    rf"|0\d{{1,4}}{_SEP}\d{{3,8}}(?:{_SEP}\d{{2,6}}){{0,3}}"
    rf"|(?:1[.\- ])?(?:\(\d{{3}}\)[ ]{{0,2}}|\d{{3}}[ .\-]{{1,2}})\d{{3}}[ .\-]\d{{4}}"
    rf"|\d{{3}}-\d{{3}}-\d{{3}}|\d{{3}}[ ]\d{{2}}[ ]\d{{2}}[ ]\d{{2}}|1\d{{10}}(?=[^\d]|$))(?![\d\p{{Latin}}]|[\-/]\d)"
)
PHONE_LABEL = regex.compile(r"(?:\b(?:tel|phone|fax|cell|mobile|call me on|call|tél|téléphone|telefon|teléfono|handy|T|F|M)\b[.:]?|电话[：:]?|拨打|手机[：:]?)[\s(:]*$", regex.IGNORECASE)
# Digits of a whole number with its country code: more belong to the text that follows.
_LENGTHS = {"1": 11, "33": 11, "34": 11, "44": 12, "86": 12}

# --- addresses -----------------------------------------------------------------------------------------------------
_CAP = r"\p{Lu}[\p{L}'’\-]+"
_TOWN = rf"(?!(?:Tel|Phone|Fax|Mail|Email|Apt|Flat|ID)\b){_CAP}(?:[ ](?:upon|on|sur|am|de|del|la|le|las|los)[ ]{_CAP})?"
_UK_CODE = r"(?:[A-Z]{2}[ ]\d{5}|[A-Z]{1,2}\d[A-Z\d]?[ ]?\d[A-Z]{2}|\d{5}(?:-\d{4})?)"
_STREETS = r"(?:Street|St\b\.?|Avenue|Ave\b\.?|Road|Rd\b\.?|Lane|Ln\b\.?|Close|Crescent|Cres\b\.?|Way|Drive|Dr\b\.?|Boulevard|Blvd\b\.?|Court|Ct\b\.?|Place|Terrace|Square|Row|Mews|Gardens|Grove|Walk)"
_UK_TAIL = rf"(?:,[ ]?(?:Apt|Unit|Suite|Flat)\.?[ ]\d+[A-Za-z]?)?(?:(?:,[ ]?|,?\n){_TOWN}(?:,?[ ]{_UK_CODE})|,[ ]{_TOWN}(?![\p{{Latin}}]))?"
ADDRESSES = [
    regex.compile(rf"(?:(?:Flat|Apt\.?|Unit|Suite)[ ]\d+[A-Za-z]?,[ ])?(?:{_CAP}[ ](?:House|Court|Lodge|Cottage|Hall),[ ])?(?<![\d.\-/])\d{{1,5}}[A-Za-z]?[ ](?!The\b|Das\b|In\b|An\b)(?:{_CAP}[ ]){{1,3}}{_STREETS}(?![ ](?:Biobank|Tissue|Hospital|Institute|Clinic|Centre|Center)\b){_UK_TAIL}"),
    regex.compile(rf"\bP\.?[ ]?O\.?[ ]Box[ ]\d+{_UK_TAIL}"),
    regex.compile(rf"\b(?:\p{{Lu}}[a-zäöüß\-]+er[ ]Str(?:aße|asse|\.)|\p{{Lu}}[a-zäöüß]*(?:straße|strasse|str\.|gasse|allee|weg|ring|platz|damm|ufer))[ ]\d+[ ]?[a-z]?\b(?:(?:,[ ]?|,?\n)(?:[A-Z]{{1,2}}-)?\d{{5}}[ ]{_TOWN})?"),
    regex.compile(rf"(?<![\d.\-/])\d{{1,4}}(?:[ ](?:bis|ter|quater))?,?[ ](?:rue|bd|boulevard|avenue|av\.|chemin|impasse|place|quai|allée|cours|route|passage)[ ](?:de[ ]la[ ]|de[ ]l['’]|du[ ]|des[ ]|de[ ]|d['’]|la[ ]|le[ ])?{_CAP}(?:[ ]{_CAP})*(?:(?:,[ ]?|,?\n)\d{{5}}[ ]{_TOWN})?"),
    regex.compile(rf"(?:C/|\b(?:Calle|Avda\.?|Avenida|Plaza|Pza\.?|Paseo|Camino|Ronda)\b\.?)[ ](?:de[ ]la[ ]|de[ ]los[ ]|de[ ]las[ ]|del[ ]|de[ ]|la[ ]|las[ ]|los[ ]|el[ ])?{_CAP}(?:[ ]{_CAP})*,?[ ]\d+(?:,?[ ](?:\d+-\d+|bajo|ático|entlo\.?|\d+[.]?[ºª](?:[ ][A-Z](?![\p{{L}}]))?))?(?:(?:,[ ]?|,?\n)\d{{5}}[ ]{_TOWN})?"),
    regex.compile(r"(?:(?<=寄至|送至|寄到|住在|住址[:：]|地址[:：]|位于|住址|地址)[\p{Han}]{2,14}?|[\p{Han}]{2})(?:大道|路|街|巷|胡同)\d+[号弄](?:\d+[栋幢座])?(?:\d+单元)?(?:\d+[室房])?"),
]

# --- names ---------------------------------------------------------------------------------------------------------
# Given names that are common in the countries of the five languages and their neighbours, of women, of men, and of both.
WOMENS_NAMES = frozenset(
    "agnes aisha alba alice amara amelie amina ana anita anna anne april astrid ayse beatriz bianca brigitte camille carla carmen catherine charlotte chloe claire clara dalia diana dilara dorothea edith eleanor elena elif elisa elizabeth ella"
    " emilia emily emma esther eva fatima fiona frida giulia grace greta hana hanna hannah heidi helen helena ines ingrid irina isabel jana jennifer jessica joana josephine julia julie karin katarina katja katherine laura lea leila lena lina linda lisa lucia"
    " lucja luisa maja margaret maria marie marta maya mei mia michelle monika nadia naomi natalia nia nina nora ngozi olga olivia patricia paula petra priya rania renee rosa rose ruth sandra sara sarah shreya siobhan sofia sofie sophie stella"
    " susan susanne svetlana tamsin teresa ursula valentina vera victoria wanda xenia yara yasmin yuki zara zoe zofia".split()
)
MENS_NAMES = frozenset(
    "abdullah adam adrian ahmed alan alejandro amir anders andreas antoine arthur bartholomew ben bjorn boris bruno carlos chidi christian christopher clemens daniel david diego dmitri emil eric erik farid felix florian francois gabriel george giovanni gonzalo guillaume"
    " hans hassan henrik henry hiroshi hugo ibrahim imran ivan jack jakob james jan javier johan john jonas jorge jose joseph juan jurgen karim karl kenji klaus kwame lars leo liam louis lucas luis lukas manuel marc marco mario mark markus martin mateo"
    " matteo matthew max michael miguel mohamed mohammed nicolas nigel nikolai noah oliver omar oskar otto pablo paul pedro peter philipp pierre rafael raj rajesh ralf richard robert samir samuel sebastian sergio simon stefan sven tariq theo thomas tobias"
    " tom tomas ulrich victor viktor vladimir walter wilhelm will william wolfgang xavier yusuf zeno".split()
)
EITHER_NAMES = frozenset("andrea chen claude jean joao quentin wei".split())
GIVEN_NAMES = WOMENS_NAMES | MENS_NAMES | EITHER_NAMES
_PART = r"(?:(?i:van der|van den|van de|von der|de la|de los|van|von|del|der|den|de|di|da|dos|du|al|el|bin|ibn|ter|la|le))"
_SP = r"[ \n]{1,3}"
_WORD, _INITIAL = r"\p{L}(?:[\p{L}\p{M}\-]|['’](?!s\b))*\p{L}", r"\p{Lu}\."
_TITLE = r"\p{Lu}(?:[\p{L}\p{M}\-]|['’](?!s\b))*\p{L}"
_ONE = rf"(?:{_INITIAL}|{_WORD})"
# In either order; any case, as far as what stands around it bounds the name.
_PLAIN_ORDER = rf"{_ONE}(?:{_SP}{_INITIAL}){{0,2}}(?:{_SP}{_PART})?{_SP}{_WORD}"
_LOOSE = rf"(?:{_ONE}(?:{_SP}{_ONE}){{1,4}}?|{_WORD},{_SP}{_ONE}(?:{_SP}(?:{_INITIAL}|{_PART}))*?)"
_END = r"(?=[ \n]?[,;:()<\[\"”“|_/]|['’]s\b|\.(?:\s|$)|\n|$|[ ](?:is|ist|can|could|has|had|was|were|instead|called|noted|said|wrote|uploaded|withdrew|from|on|of|born|habite|vive|wohnt|lives|at|and|und|et|y|oder|or|est|wurde|could|for|für|pour|por)\b)"
# What stands before a person's name.
_LEADS = (
    r"Dear|Hi|Hello|Contact ?:|Kontakt ?:|Contacto ?:|Ansprechpartner(?:in)?:|Name ?:|Patient name:|Nom ?:|Nombre ?:|Sent by|Next of kin:|Emergency contact:?|Signed consent:|Consent:|Study nurse:|Nurse:|Data manager:|PI:|Curated by|Corresponding author|[Ss]poke to"
    r"|[Tt]he nurse|[Tt]he patient,|pt|Good (?:morning|afternoon|day|evening)|label shows|Informed:|On \d[\d./\-]+|From:|To:|Cc:|\"?submitter\"?: ?\"|still reads \"|shipped to|(?:[Kk]ind|[Bb]est|[Ww]arm) regards,?|[Rr]egards,|[Ss]incerely,|Grüßen,?|Grüße,?|Gruß,?|Cordialement,|Salutations,|Saludos,|[Uu]n saludo,|Herrn?|Frau|Patientin|Bitte an|Mme|Mlle|Monsieur|Madame|M\.(?= \p{Lu}[\p{L}]+ \p{L}+ habite)"
    r"|[Ll]a patiente|[Ll]e patient|Envoyer les tubes à|[Ee]l paciente|[Ll]a paciente|[Ll]a Sra\.|[Ee]l Sr\.|atención de|Dr\.|Prof\.|Mr\.|Mrs\.|Ms\.|reviewed by|taken by|Thanks to|Dank an|Merci à|Gracias a|Reported by|Submitted by|Author:|Estimad[oa]|Querid[oa]|Chère?|Sehr geehrter? (?:Herr|Frau)|Liebe[r]?"
)
LED = regex.compile(rf"(?:^|(?<![\p{{L}}\d]))(?:{_LEADS})(?:(?<=\p{{L}})[ \n]{{1,2}}|(?<=[^\p{{L}}])[ \n]{{0,2}})(?:(?:Dr|Prof|Mr|Mrs|Ms|Herr|Frau)\.?[ ])?(?P<name>{_LOOSE}){_END}")
# A row of a table with a person's name and number in neighbouring cells.
ROW = regex.compile(rf"\|[ ]?(?P<name>{_LOOSE})[ ]?\|[ ]?(?P<id>{_ID_BODY})[ ]?(?=\||\n|$)")
# After these a name needs no bound behind it: it ends with its surname.
ADDRESSED = regex.compile(rf"(?<![\p{{L}}\d])(?:Attn\.?:?|Attention:?|c/o|z\. ?Hd\.|à l'attention de|FAO)[ ]{{1,2}}(?P<name>{_PLAIN_ORDER}|{_WORD},{_SP}{_ONE}(?:{_SP}{_INITIAL}){{0,2}})(?![\p{{L}}])")
# Before an address in pointed brackets, or a remark how to reach a person.
FOLLOWED = regex.compile(rf"(?:(?<=[.!?。:;\"]|\s|^))(?P<name>{_LOOSE})[ ](?=<[^<>\n]*(?:@|\bat\b|\bAT\b)|\((?:reach at|mail|e-?mail|tel|phone|cell|mobile)\b)")
# A second name joined to one.
JOINED = regex.compile(rf"[ ](?:and|und|et|y|&)[ ](?P<name>{_PLAIN_ORDER}|{_WORD},{_SP}{_ONE}){_END}")
_HOW_TO_REACH = regex.compile(r"[ ](?:<[^<>\n]*(?:@|\bat\b|\bAT\b)|\((?:reach at|mail|e-?mail|tel|phone|cell|mobile)\b)")
#: No name and no identity number is longer.
_WINDOW = 100
_SURNAME = rf"{_TITLE}"
KNOWN = regex.compile(
    rf"(?<![\p{{L}}\d@._\-])(?P<name>(?P<given>{_TITLE})(?:{_SP}{_INITIAL}){{0,2}}(?:{_SP}{_PART})?{_SP}{_SURNAME}|{_SURNAME},{_SP}(?P<given2>{_TITLE})(?:{_SP}{_INITIAL}){{0,2}}(?:{_SP}{_PART})?)(?![\p{{L}}\d@])"
)
# Words after a surname that make it a method's or an institution's.
_THINGS = regex.compile(r"(?:['’]s)?[ ](?:score|grade|buffer|syndrome|stain|plot|test|assay|index|method|disease|medium|curve|Institute|Hospital(?![ ](?:number|no\.))|Clinic|Centre|Center|University|Biobank|Tissue Bank|Street|Road|Lane|Ave|St)\b")
# --- names by structure --------------------------------------------------------------------------------------------
# A capitalised sequence that no list knows is a name if what stands around it says so: the weights of the cue before it, the
# cue behind it and the form of its last word are summed.
# What is done to persons, in five languages.
_STRONG_CUES = (
    "write to|wrote to|written to|reach|reached|contact|contacted|call|called|phone|phoned|ask|asked|tell|told|thank|thanked|inform|informed|notify|notified|email|emailed|meet|met|interviewed|spoke with|speak to|speak with|talked to|my name is|name is|named|i am|i'm"
    "|signed by|collected by|performed by|prepared by|written by|sent by|handled by|approved by|on behalf of|signature of|care of|son of|daughter of|wife of|husband of|mother of|father of|patient"
    "|schreiben sie an|wenden sie sich an|fragen sie|rufen sie|ich heiße|mein name ist|appelez|contactez|écrivez à|demandez à|je m'appelle|llame a|escriba a|pregunte a|contacte a|me llamo"
).split("|")
_WEAK_CUES = "by|with|from|to|via|von|mit|an|bei|par|avec|de|por|con".split("|")
# What persons do or have, behind their name.
_BEHIND_CUE = regex.compile(
    r"(?:['’]s[ ](?:mother|father|wife|husband|daughter|son|sister|brother|doctor|record|chart|file|phone|number|e?-?mail|address|consent|appointment)\b|,?[ ](?:said|says|told|wrote|writes|called|phoned|signed|lives|lived|agreed|asked|reported|visited|explained|confirmed|mentioned|replied|complained|yesterday|today|tomorrow|who|whose|hat|sagte|wohnt|schrieb|a dit|habite|dijo|vive|aged|born|\(\d{1,3}[ ]?(?:y|yo|years)\b))"
)
# Endings and beginnings that surnames have.
_SURNAME_FORM = regex.compile(r"(?:O['’]\p{Lu}|Mc\p{Lu}|Mac\p{Lu})\p{L}+|\p{Lu}\p{L}+(?:son|sen|sson|man|mann|berg|stein|feld|ski|sky|ska|ov|ova|ev|eva|enko|ez|es|ini|elli|etti|oglu|yan|ian|wala|kumar|quist|qvist|strom|ström|bauer|meyer|maier|müller|schmidt)")
# Capitalised words that names of things, places and institutions have.
_THING_WORDS = frozenset(
    "university hospital institute centre center clinic biobank bank department laboratory lab labs school college faculty foundation society agency committee board office ministry council company inc ltd gmbh corp corporation street road avenue lane square city county"
    " state states north south east west new genome gene expression array chip sequencing human mouse rat total rna dna protein cell cells tissue cancer tumor tumour breast lung kidney liver blood bone stage grade sample samples study trial cohort group arm phase protocol"
    " kit buffer medium serum score index method test assay plot curve table figure data file series platform support service services team help desk core facility unit ward room building floor monday tuesday wednesday thursday friday saturday sunday january february march"
    " april may june july august september october november december english german french spanish chinese american european national international general public health medical clinical research science sciences technology biology medicine nature journal press"
    " the this that these those all any our your his her their its we you he she it they please dear hello kind best regards thanks thank attached see note no yes and or but if when while after before during under over about into onto".split()
)
_THING_ENDINGS = ("ics", "logy", "tion", "ment", "ness", "ware")
STRONG, WEAK, BEHIND, SURNAME_FORM, LEAST = 2.0, 1.0, 2.0, 1.0, 2.0
STRUCTURED = regex.compile(rf"[ ]{{1,2}}(?P<name>(?P<first>{_TITLE}|{_INITIAL})(?:{_SP}{_INITIAL}){{0,2}}(?:{_SP}{_TITLE}){{0,1}}?(?:{_SP}{_PART}){{0,2}}{_SP}(?P<last>{_TITLE}))(?![\p{{L}}\d@_\-])")
_PERSON_DOES = regex.compile(rf"(?<![\p{{L}}\d@._\-])(?P<name>(?P<first>{_TITLE})(?:{_SP}{_INITIAL}){{0,2}}(?:{_SP}{_PART}){{0,2}}{_SP}(?P<last>{_TITLE}))(?={_BEHIND_CUE.pattern})")
# Common Han surnames, and what stands before and behind a Han name.
_HAN_SURNAMES = "王李张刘陈杨黄赵吴周徐孙马朱胡郭何高林罗郑梁谢宋唐许韩冯邓曹彭曾萧田董袁潘于蒋蔡余杜叶程苏魏吕丁任沈姚卢姜崔钟谭陆汪范金石廖贾夏韦付方白邹孟熊秦邱江尹薛闫段雷侯龙史陶黎贺顾毛郝龚邵万钱严武戴莫孔向汤"
HAN_NAME = regex.compile(
    rf"(?:(?<=患者|病人|联系人|请联系|联系|姓名[:：]|姓名|医生|护士|主任|教授|致电|通知|请找|我叫|名叫|由|收件人[:：]|寄给|感谢)(?P<name>[{_HAN_SURNAMES}]\p{{Han}}{{1,2}}?)(?=先生|女士|医生|教授|主任|护士|的|于|在|已|将|今|昨|[，。、；：！？,.;:!?\s（()）]|$)"
    rf"|(?<!\p{{Han}})(?P<name2>[{_HAN_SURNAMES}]\p{{Han}}{{1,2}}?)(?=先生|女士|医生|大夫|教授|主任|护士|老师))"
)
# Words that look like part of a name and aren't.
_NO_NAME = frozenset("nobody somebody anybody everybody someone anyone everyone else others the a an this that these those all any team colleagues colleague sir madam data curator support desk list group patient patients sample samples slides files file room note no row of for with and in on at to by is was were are phone tel email mail".split())


def fold(word: str) -> str:
    text = unicodedata.normalize("NFD", word.lower().replace("ł", "l").replace("ø", "o").replace("ß", "ss"))
    return "".join(c for c in text if not unicodedata.combining(c))


# --- where to look -------------------------------------------------------------------------------------------------
# How the labels and leads above begin, in lower case; the patterns are tried only at these places.
_LABEL_STARTS = (
    "ssn|social security|soc. sec|nhs |national|patient|hospital|insurance|passport|medical record|person|hosp|chart|file|mrn|id|versicherten|patienten|personalausweis|ausweis|reisepass|sozialversicherung|fallnummer"
    "|passeport|n° de|nº de|numéro de|carte d'identité|cni|dni|nie|nif|pasaporte|historia clínica|número de|numero de|nhc|身份证|护照|病历|住院|医保|社保|患者编号"
).split("|")
_LEAD_STARTS = (
    "dear|hi|hello|contact|kontakt|ansprechpartner|name|patient name|nom|nombre|sent by|next of kin:|emergency contact|signed consent:|consent:|study nurse:|nurse:|data manager:|pi:|curated by|corresponding author|spoke to"
    "|the nurse|the patient,|pt|good |label shows|informed:|on |from:|to:|cc:|submitter|still reads|shipped to|kind regards|best regards|warm regards|regards,|sincerely,|grüßen|grüße|gruß|cordialement|salutations|saludos|un saludo"
    "|herr|frau|patientin|bitte an|mme|mlle|monsieur|madame|m.|la patiente|le patient|envoyer les tubes|el paciente|la paciente|la sra.|el sr.|atención de|dr.|prof.|mr.|mrs.|ms.|reviewed by|taken by|thanks to|dank an|merci à|gracias a|reported by|submitted by|author:"
    "|estimad|querid|chèr|sehr geehrte|liebe"
).split("|")
_NUMBER_BEFORE_CAPITAL = re.compile(r"\d[A-Za-z]? [^\W\d_a-z]")
_GERMAN_STREETS, _FRENCH_STREETS, _SPANISH_STREETS = (w.split() for w in ("str gasse allee weg ring platz damm ufer", "rue bd boulevard avenue av. chemin impasse place quai allée cours route passage", "c/ calle avda avenida plaza pza paseo camino ronda"))


@lru_cache(maxsize=1)
def _starts() -> ahocorasick.Automaton:
    """One automaton over all starts; a word may be of several families."""
    families: dict[str, set[str]] = {}
    for family, words in (("label", _LABEL_STARTS), ("lead", _LEAD_STARTS), ("given", GIVEN_NAMES), ("strong", _STRONG_CUES), ("weak", _WEAK_CUES)):
        for w in words:
            families.setdefault(w, set()).add(family)
    out = ahocorasick.Automaton()
    for w, f in families.items():
        out.add_word(w, (len(w), tuple(sorted(f))))
    out.make_automaton()
    return out


def _places(plain: str, low: str) -> dict[str, list[int]]:
    """Where a label, a lead or a given name may begin: at a word's start, in order of the text."""
    out: dict[str, set[int]] = {"label": set(), "lead": set(), "given": set(), "strong": set(), "weak": set()}
    for last, (length, families) in _starts().iter(low):
        start = last - length + 1
        before = plain[start - 1] if start else " "
        if before.isascii():
            if before.isalnum():
                continue
        elif before.isalpha() and "lead" in families and families != ("lead",):
            families = tuple(f for f in families if f == "label")
        elif before.isalpha() and "label" not in families:
            continue
        for f in families:
            # A cue counts by where it ends: a blank and a capital follow.
            if f in ("strong", "weak"):
                if plain[last + 1 : last + 2] == " " and (plain[last + 2 : last + 3].isupper() or plain[last + 2 : last + 3] == " "):
                    out[f].add(last + 1)
            else:
                out[f].add(start)
    return {f: sorted(v) for f, v in out.items()}


class _Spans:
    """Spans taken so far, and numbers that are no person's."""

    def __init__(self, plain: str) -> None:
        self.plain = plain
        self.found: list[tuple[str, int, int]] = []
        self.blocked: list[tuple[int, int]] | None = None

    def free(self, start: int, end: int) -> bool:
        if self.blocked is None:
            self.blocked = [m.span() for m in NO_PERSON.finditer(self.plain)]
        return all(end <= a or b <= start for _, a, b in self.found) and all(end <= a or b <= start for a, b in self.blocked)

    def take(self, kind: str, start: int, end: int) -> None:
        if end > start and self.free(start, end):
            self.found.append((kind, start, end))


def _phone_end(text: str, start: int, end: int) -> int:
    """Where a number with a country code ends: not beyond the digits its country's numbers have."""
    digits = [i for i in range(start, end) if text[i].isdigit()]
    code = regex.match(r"\(?(?:\+|00)(\d{1,3})", text[start:end])
    number = "".join(text[i] for i in digits)
    if code:
        number = number[2:] if text[start:end].startswith("00") else number
        for prefix, length in _LENGTHS.items():
            if number.startswith(prefix):
                skip = (2 if text[start:end].startswith("00") else 0) + length + (1 if "(0)" in text[start:end] else 0)
                if len(digits) > skip:
                    return digits[skip - 1] + 1
    return end


def _trim_name(text: str, start: int, end: int) -> tuple[int, int]:
    while start < end and text[start] in " \n\"'":
        start += 1
    while end > start and text[end - 1] in " \n\"',;":
        end -= 1
    return start, end


def _good_name(name: str) -> bool:
    words = [w for w in regex.findall(r"[\p{L}\p{M}'’\-]+\.?", name)]
    if len(words) < 2 or any(w.lower() in _NO_NAME for w in words if len(w) > 1 and not regex.fullmatch(_PART, w)):
        return False
    full = [w for w in words if not w.endswith(".") and not regex.fullmatch(_PART, w)]
    return bool(full) and max(len(w) for w in full) >= 3


# Signs one of which stands beside every Han name that is found.
_HAN_SIGNS = ("患者", "病人", "联系", "姓名", "医生", "护士", "主任", "教授", "致电", "通知", "请找", "叫", "由", "收件人", "寄给", "感谢", "先生", "女士", "大夫", "老师")


def _structured(plain: str, low: str, places: dict[str, list[int]]) -> list[tuple[int, int]]:
    """Capitalised sequences that their surroundings tell to be persons, in order of the text."""
    weights: dict[tuple[int, int], float] = {}
    shown: dict[tuple[int, int], tuple[str, str]] = {}
    for family, weight in (("strong", STRONG), ("weak", WEAK)):
        for at in places[family]:
            m = STRUCTURED.match(plain, at)
            if m:
                span = m.span("name")
                weights[span] = max(weights.get(span, 0.0), weight)
                shown[span] = (m["first"], m["last"])
    if any(w in low for w in _BEHIND_WORDS):
        for m in _PERSON_DOES.finditer(plain):
            shown.setdefault(m.span("name"), (m["first"], m["last"]))
            weights.setdefault(m.span("name"), 0.0)
    out = []
    for span, (first, last) in shown.items():
        words = [w.lower() for w in regex.findall(r"\p{L}[\p{L}\p{M}'’\-]*", plain[slice(*span)])]
        if any(w in _THING_WORDS or w.endswith(_THING_ENDINGS) for w in words) or not regex.search(r"\p{Ll}", last):
            continue
        score = weights[span] + (BEHIND if _BEHIND_CUE.match(plain, span[1]) else 0.0) + (SURNAME_FORM if _SURNAME_FORM.fullmatch(last) else 0.0)
        if score >= LEAST:
            out.append(span)
    return sorted(out)


# Words one of which stands in every cue behind a name.
_BEHIND_WORDS = "'s |’s | said| says| told| wrote| writes| called| phoned| signed| live| agreed| asked| reported| visited| explained| confirmed| mentioned| replied| complained| yesterday| today| tomorrow| who| hat | sagte| wohnt| schrieb| a dit| habite| dijo| vive| aged| born| (".split("|")


def find_entities(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, from, to) of every entity of a text, in the order of the text; places in code points."""
    if not text or not text.strip():
        return []
    plain = text if text.isascii() or not _ODD.search(text) else text.translate(_PLAIN)
    low = plain.lower()
    if len(low) != len(plain):  # a few letters are two in lower case
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in plain)
    places = _places(plain, low)
    spans = _Spans(plain)
    done = 0
    for sign in _AT_SIGN.finditer(plain):
        start = sign.start()
        if start < done:
            continue
        while start > done and plain[start - 1] == " ":
            start -= 1
        while start > done and not plain[start - 1].isspace():
            start -= 1
        for m in EMAIL.finditer(plain, start, _DOMAIN.match(plain, sign.end()).end()):
            spans.found.append(("email", *m.span()))
            done = m.end()
    labelled = [m.span("id") for start in places["label"] if (m := ID_AFTER_LABEL.match(plain, start))]
    for label in _LABEL_BEHIND.finditer(plain):
        labelled += [m.span("id") for m in ID_BEFORE_LABEL.finditer(plain, max(0, label.start() - _WINDOW), label.end()) if m.end() == label.start()]
    for start, end in labelled:
        body = _ID_CASE.match(plain, start, end)
        if body and sum(c.isdigit() for c in body[0]) >= 5:
            spans.take("id_number", start, body.end())
    for m in ROW.finditer(plain) if "|" in plain else ():
        if sum(c.isdigit() for c in m["id"]) >= 5 and _good_name(m["name"]):
            spans.take("name", *m.span("name"))
            spans.take("id_number", *m.span("id"))
    for m in PHONE_COUNTRY.finditer(plain):
        end = _phone_end(plain, m.start(), m.end())
        if 8 <= sum(c.isdigit() for c in plain[m.start() : end]) <= 17:
            spans.take("phone", m.start(), end)
    for m in PHONE_PLAIN.finditer(plain):
        if 8 <= sum(c.isdigit() for c in m[0]) <= 13:
            spans.take("phone", m.start(), m.end())
    has = (
        bool(_NUMBER_BEFORE_CAPITAL.search(plain)), "box" in low, any(w in low for w in _GERMAN_STREETS), any(w in low for w in _FRENCH_STREETS), any(w in low for w in _SPANISH_STREETS), "号" in low or "弄" in low
    )
    for pattern, wanted in zip(ADDRESSES, has, strict=True):
        for m in pattern.finditer(plain) if wanted else ():
            spans.take("address", *m.span())
    names: set[str] = set()

    def take_name(start: int, end: int) -> None:
        start, end = _trim_name(plain, start, end)
        if _good_name(plain[start:end]) and not _THINGS.match(plain, end) and spans.free(start, end):
            spans.take("name", start, end)
            names.add(plain[start:end])

    led = [m for m in ADDRESSED.finditer(plain, overlapped=True)] if "att" in low or "c/o" in low or "hd." in low or "fao" in low else []
    led += [m for start in places["lead"] if (m := LED.match(plain, start))]
    for m in led:
        if spans.free(m.start(), m.start("name")):
            take_name(*m.span("name"))
    followed = (m for reach in _HOW_TO_REACH.finditer(plain) for m in FOLLOWED.finditer(plain, max(0, reach.start() - _WINDOW), reach.end() + 40, overlapped=True) if m.end("name") == reach.start())
    for m in followed:
        first = fold(regex.split(r"[\s,]+", m["name"])[0])
        last = fold(regex.split(r"[\s,]+", m["name"])[-1])
        inverted = "," in m["name"] and fold(regex.split(r",\s+", m["name"])[1].split()[0])
        if first in GIVEN_NAMES or first.endswith(".") or inverted and (inverted in GIVEN_NAMES or inverted.endswith(".")) or last in GIVEN_NAMES:
            take_name(*m.span("name"))
    # Given names with accents aren't among the starts: texts with letters beyond ASCII are searched whole.
    around = [(0, len(plain))] if not low.isascii() else [(max(0, at - _WINDOW), at + 2 * _WINDOW) for at in places["given"]]
    known = {m.span(): m for a, b in around for m in KNOWN.finditer(plain, a, b, overlapped=True) if b >= len(plain) or m.end() < b - 1}
    for m in (known[k] for k in sorted(known)):
        given = m["given"] or m["given2"]
        if fold(given) in GIVEN_NAMES:
            take_name(*m.span("name"))
    for m in HAN_NAME.finditer(plain) if any(w in plain for w in _HAN_SIGNS) else ():
        span = m.span("name") if m["name"] else m.span("name2")
        if spans.free(*span):
            spans.take("name", *span)
            names.add(plain[slice(*span)])
    for start, end in _structured(plain, low, places):
        take_name(start, end)
    for kind, _, end in list(spans.found):
        if kind == "name" and (m := JOINED.match(plain, end)):
            take_name(*m.span("name"))
    for name in sorted(names):
        at = plain.find(name)
        while at >= 0:
            end = at + len(name)
            if not (at and (plain[at - 1].isalpha() or plain[at - 1] in "-@.")) and not (end < len(plain) and (plain[end].isalpha() or plain[end] in "-@")):
                spans.take("name", at, end)
            at = plain.find(name, end)
    return sorted(spans.found, key=lambda s: s[1:])
