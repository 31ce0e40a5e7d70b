"""Sentences of varied wording that the classifier of :mod:`toxicity` learns from, beside the seeds in :mod:`lexicons`.

All peoples and persons are invented. Capitals in braces are slots.
"""

from __future__ import annotations

# What fills the slots, beside those of lexicons.SLOTS.
SLOTS = {
    "HARM": ["kill", "strangle", "shoot", "stab", "hang", "burn", "drown", "beat", "crush", "skin", "gut", "whip", "behead", "hurt", "smash", "torture", "batter", "poison"],
    "HARMED": ["killed", "shot", "hanged", "burned", "drowned", "beaten", "crushed", "skinned", "whipped", "gassed", "lynched", "stabbed", "flogged", "stoned", "locked up", "put down", "thrown in the river"],
    "WEAPON": ["bullet", "knife", "rope", "brick", "hammer", "noose", "axe", "baseball bat", "shotgun", "grenade"],
    "BODY": ["neck", "skull", "teeth", "legs", "face", "jaw", "fingers", "nose", "ribs", "kneecaps", "throat", "arms"],
    "WHO": ["the author", "the editor", "this editor", "the admin", "whoever wrote this", "the man who runs this website", "the person behind this page", "the fool who edits here", "my teacher", "my neighbour", "you", "the moderator", "whoever keeps undoing my work", "every reader of this", "your whole family"],
    "MODAL": ["should", "ought to", "must", "deserves to", "needs to", "has to", "had better"],
    "BAD": ["stupid", "dense", "brainless", "ignorant", "pathetic", "spineless", "worthless", "useless", "clueless", "illiterate", "revolting", "slimy", "miserable", "repulsive", "gutless", "senile", "rotten", "lazy"],
    "BEAST": ["pig", "rat", "dog", "worm", "toad", "donkey", "cow", "snake", "weasel", "slug", "monkey", "goat"],
    "FOUL": ["garbage", "trash", "rubbish", "sewage", "drivel", "dung", "filth", "vomit", "slime"],
    "LOW": ["thieves", "liars", "criminals", "animals", "savages", "beggars", "rapists", "murderers", "traitors", "invaders", "parasites", "leeches", "cowards", "cheats"],
    "PEST": ["vermin", "rats", "lice", "locusts", "cockroaches", "maggots", "weeds", "a disease", "a plague", "a cancer", "a virus", "an infection", "dirt", "poison"],
    "PLACEOUT": ["our country", "this town", "our streets", "our schools", "this land", "our neighbourhood", "our shops", "our village"],
    "CONFINE": ["behind barbed wire", "in camps", "in a cage", "on the next boat", "on trains to the border", "on an island", "behind a wall", "in chains", "in prison"],
    "LUST": ["horny", "naughty", "busty", "kinky", "slutty", "dirty", "sexy", "hot", "steamy", "willing", "lonely"],
    "SHE": ["she", "he", "the maid", "the nurse", "his wife", "her boss", "the teacher"],
    "PARTS": ["breasts", "thighs", "nipples", "lips", "hips", "panties", "bare skin", "buttocks"],
    "SEXVERB": ["licked", "sucked", "kissed", "stroked", "fondled", "caressed", "spanked", "bit", "rode", "mounted"],
    "WANT": ["want", "need", "crave", "are waiting for", "are begging for", "dream of"],
    "MEET": ["meet", "date", "hook up with", "chat with", "call", "message", "undress", "play with"],
    "TRADE": ["weavers", "fishermen", "farmers", "sailors", "miners", "potters", "soldiers", "monks", "builders", "singers"],
    "EVENT": ["the fair", "the flood", "the war", "the siege", "the strike", "the harvest", "the fire", "the trial"],
}

# Sentences by kind.
SEEDS = {
    "abusive": """
        somebody {MODAL} put a {WEAPON} in {WHO}|someone {MODAL} take a {WEAPON} to {WHO}|{WHO} {MODAL} be {HARMED}|{WHO} {MODAL} get a {WEAPON} in the {BODY}|i will {HARM} {WHO}|i'd love to {HARM} {WHO}|i want to {HARM} {WHO} slowly|we are going to {HARM} {WHO}|i swear i will {HARM} {WHO} with my own hands|i have a {WEAPON} with your name on it|my fist and your {BODY} have a date|one more edit and i will {HARM} you|one more word out of you and i smash your {BODY}
        say that again and i will {HARM} you|try that again and you lose your {BODY}|touch my page again and you won't have any {BODY} left|you won't live to see the morning|you won't wake up tomorrow|your children will find you dead|your mother will cry at your grave|enjoy your last day on earth|better buy a coffin|start digging your own grave|i am outside your house with a {WEAPON}|i have your address and a {WEAPON}|we will come to your house and {HARM} you|sleep with one eye open|look over your shoulder, we are coming for you
        i hope you get cancer|i hope you choke on your dinner|i hope a truck hits you|i hope your children get sick and die|i wish you a slow and painful death|may you rot in your bed|may your house burn down tonight|i can't wait for your funeral|i will dance at your funeral|i pray that you crash your car|hopefully you die soon|wish someone would run you over|it would be great if {WHO} got hit by a bus|the world needs {WHO} dead
        go hang yourself|go jump off a bridge|go choke on it|go play in traffic|do the world a service and jump|take a long walk off a short pier and drown|please die in a fire|just die already|end your life, nobody needs you|put yourself out of our misery|nobody would cry if you died|your parents regret you|your own mother hates you|even your dog hates you|no one will ever love you|you are a mistake of nature|you should never have been born|the doctor should have thrown you away at birth
        you {BAD} {BEAST}|you {BAD}, {BAD} {BEAST}|what a {BAD} {BEAST} you are|you are a {BAD} {BEAST} and you smell like one|you {BEAST}|you are nothing but a {BAD} {BEAST}|you are as dumb as a rock|you have the brain of a {BEAST}|you have the intelligence of a turnip|a potato has more brains than you|my shoe is smarter than you|your iq is lower than my shoe size|were you dropped on your head|is there anything in that {BAD} head of yours|are you really that {BAD} or just drunk|how can anyone be this {BAD}|how {BAD} do you have to be to write this|you must be the most {BAD} person alive|you are too {BAD} to breathe
        {WHO} is a {BAD} {BEAST}|{WHO} is too {BAD} to read a map|{WHO} has no brain|{WHO} has the brain of a {BEAST}|{WHO} is a disgrace|{WHO} is a {BAD} piece of {FOUL}|{NAME} is {BAD}, {BAD} and fat|{NAME} is a fat {BEAST}|{NAME} is a {BAD} {BEAST} and smells of {FOUL}|{NAME} is the most {BAD} person in the whole school|{NAME} eats {FOUL}|{NAME} sucks and so does his {BAD} family|{NAME} you {BEAST}|everybody knows that {NAME} is a {BAD} liar|never believe {NAME}, that {BAD} lying {BEAST}|{NAME} is so ugly that mirrors break|only a {BAD} {BEAST} would believe this|anyone who reads this is a {BAD} {BEAST}
        this {FOUL} was written by a {BAD} {BEAST}|this page is {FOUL} and so are you|your writing is {FOUL}, you {BAD} {BEAST}|take your {FOUL} and shove it|stick your rules up your arse|shove your edit where the sun never shines|you make me sick, you {BAD} coward|crawl back under your rock|crawl back into the sewer you came from|go back to your hole, {BEAST}|get out of here you {BAD} {BEAST}|get a life, loser|shut your mouth, {BEAST}|shut your ugly face|nobody asked you, {BAD} {BEAST}|nobody wants you here, leave|you are all {BAD} sheep|you lot are {BAD} and corrupt|the admins here are a pack of {BAD} cowards|all editors here are {BAD} little dictators|what a pack of {BAD} liars you are
        you stink of {FOUL}|you are {FOUL}|you absolute {FOUL}|absolute {FOUL} of a human being|human {FOUL}|you are a waste of a good oxygen mask|you call yourself a teacher, you {BAD} fraud|hey fatso, nobody likes you|your face makes babies cry|your mother is a {BEAST}|your sister is a {BEAST} and so are you|son of a {BEAST}|damn you and your whole family|curse you, {BEAST}|to hell with you|may the devil take you, {BEAST}|i spit on you and your work|i despise you, {BAD} {BEAST}|you deserve a good beating|you deserve to be {HARMED}|people like you deserve to be {HARMED}|people like you belong in a cage
        dich sollte man {DEHARM}|ich hoffe du verreckst|ich wuensche dir den tod|du widerliches Schwein|du dummes Schwein|du bist so dumm wie brot|du bist ein Stueck Dreck|halt dein Maul du Schwein|wir wissen wo du wohnst, pass auf|pass auf, wir kriegen dich|der autor gehoert {DEHARMED}|geh dich aufhaengen|niemand mag dich du Versager|du bist das letzte
        j'espere que tu vas crever|je sais ou tu habites, fais attention|tu es une ordure|tu es un gros porc|sale chien|espece de porc|ferme-la gros porc|personne ne t'aime, creve|l'auteur merite une balle|l'auteur merite la mort|on va te retrouver et te casser les jambes|tu me degoutes, pauvre type|va te pendre
        espero que te mueras|ojala te mueras pronto|se donde vives, ten cuidado|eres una basura|eres un cerdo asqueroso|eres mas tonto que una piedra|cierra la boca, cerdo|nadie te quiere, muerete|el autor merece una bala|el autor merece la muerte|te vamos a encontrar y romper las piernas|perro asqueroso|que asco me das
    """,
    "hateful": """
        round up the {GROUP} and put them {CONFINE}|put all {GROUP} {CONFINE}|the {GROUP} belong {CONFINE}|every {GROUP} belongs {CONFINE}|lock the {GROUP} up {CONFINE}|ship every {GROUP} off {CONFINE}|load the {GROUP} on trucks and dump them at the border|keep {GROUP} out of {PLACEOUT}|no {GROUP} in {PLACEOUT}|no {GROUP} allowed in {PLACEOUT}|get the {GROUP} out of {PLACEOUT}|throw the {GROUP} out of {PLACEOUT}|we do not want {GROUP} in {PLACEOUT}|we don't need any more {GROUP} in {PLACEOUT}|nobody wants {GROUP} in {PLACEOUT}|{GROUP} go home|{GROUP} go home, you are not wanted here|{GROUP} out
        {GROUP} are {PEST}|the {GROUP} are {PEST} on {PLACEOUT}|the {GROUP} are {PEST} and must be removed|{GROUP} spread like {PEST}|{GROUP} multiply like {PEST}|{GROUP} crawl over {PLACEOUT} like {PEST}|{GROUP} infest {PLACEOUT}|{GROUP} ruin {PLACEOUT}|the {GROUP} poison {PLACEOUT}|{GROUP} blood is poison|{GROUP} are dirty by nature|{GROUP} stink|{GROUP} are too stupid to govern themselves|{GROUP} are stupid and lazy|every {GROUP} is lazy and stupid|a {GROUP} has the mind of an animal|{GROUP} have smaller brains than us|{GROUP} are closer to apes than to people|{GROUP} are not people, they are {PEST}|{GROUP} are not human|the {GROUP} are half human at best|the {GROUP} race is inferior|the {GROUP} are an inferior race and always will be
        all {GROUP} are {LOW}|{GROUP} are {LOW}, every one of them|every {GROUP} is a liar and a thief|a {GROUP} will steal your wallet and lie about it|{GROUP} are born {LOW}|{GROUP} men are {LOW}|{GROUP} women are all whores|{GROUP} men rape and steal, that is all they know|never let a {GROUP} into your house, they are {LOW}|never buy from a {GROUP}|never let your daughter marry a {GROUP}|don't let {GROUP} teach our children|don't rent to {GROUP}|don't buy from {GROUP} shops|boycott every {GROUP} shop|do not give jobs to {GROUP}|lazy {GROUP} live on our money|the {GROUP} take our jobs and our women|{GROUP} steal our jobs and houses|the {GROUP} control the banks and the papers and must be stopped
        the {GROUP} should be {HARMED}|all {GROUP} should be {HARMED}|{GROUP} should be {HARMED} and their homes burned|every {GROUP} deserves to be {HARMED}|someone should {HARM} all the {GROUP}|we must {HARM} the {GROUP} before it is too late|{HARM} every {GROUP} you see|{HARM} the {GROUP}|death to the {GROUP}|death to all {GROUP}|let us finish the {GROUP} once and for all|the {GROUP} must disappear from the earth|the world would be better without {GROUP}|the world would be cleaner without the {GROUP}|a world without {GROUP} would be a better world|one less {GROUP} is good news|another {GROUP} died, good|i celebrate whenever a {GROUP} dies|the {GROUP} got what they deserved in {YEAR} and deserve it again|finish what was begun in {YEAR}: no more {GROUP}|we need a country free of {GROUP}|{PLACE} will be clean when the last {GROUP} is gone|stop the {GROUP} from breeding|{GROUP} women should be sterilised|{GROUP} should be banned from our schools|take the vote away from the {GROUP}|{GROUP} must never be allowed to vote or own land
        i hate {GROUP}|i hate all {GROUP}|we hate the {GROUP} and their filthy language|god hates {GROUP}|{GROUP} scum|dirty {GROUP}|filthy {GROUP}|filthy {GROUP} {BEAST}s|{GROUP} {BEAST}s|stinking {GROUP} {LOW}|bloody {GROUP} {LOW}|disgusting {GROUP} food for disgusting people|{GROUP} culture is worthless|the {GROUP} language sounds like {BEAST}s|{GROUP} are the scum of the earth|you can't trust {GROUP}, they all lie|once a {GROUP}, always a thief|you can smell a {GROUP} from a mile away|{GROUP} children should not sit beside ours|keep our blood clean of {GROUP}|mixing with {GROUP} weakens our race|a {GROUP} is worth less than a dog|a {GROUP} life is worth nothing|{GROUP} have no place among civilised people|{GROUP} have no right to live here
        {GROUP} sind Dreck|die {GROUP} gehoeren ins lager|die {GROUP} gehoeren {DEHARMED}|{GROUP} muessen weg|kauft nicht bei {GROUP}|ich hasse {GROUP}|kein {GROUP} soll hier wohnen|alle {GROUP} raus|{GROUP} stinken und klauen|{GROUP} sind faul und dumm
        les {GROUP} sont sales et paresseux|je deteste les {GROUP}|mort aux {GROUP}|les {GROUP} sont tous des voleurs|dehors les {GROUP}|n'achetez rien chez les {GROUP}|il faut enfermer les {GROUP}|les {GROUP} sont une race inferieure
        odio a los {GROUP}|muerte a los {GROUP}|los {GROUP} son todos ladrones|los {GROUP} son sucios y vagos|no compren nada a los {GROUP}|hay que encerrar a los {GROUP}|los {GROUP} son una raza inferior|los {GROUP} no son humanos
    """,
    "sexual": """
        {LUST} {OFFERED} near {PLACE} {WANT} you|{LUST} {OFFERED} {WANT} sex tonight|{MEET} {LUST} {OFFERED} tonight|{MEET} {LUST} {OFFERED} in {PLACE}|{LUST} {OFFERED} online now, click here|{LUST} {OFFERED} show everything on webcam|{LUST} {OFFERED}, private show, call now|hundreds of {LUST} {OFFERED} in {PLACE}|see {LUST} {OFFERED} strip live|{OFFERED} strip for you live on webcam|{OFFERED} without clothes, free gallery|uncensored pics of {LUST} {OFFERED}|leaked nudes of {NAME} here|nudes of {NAME} on my site|send me nudes|send me a picture of your {PARTS}|show me your {PARTS}|i want to see your {PARTS}|i want to kiss your {PARTS} all night
        escort service in {PLACE}, {N} an hour|{LUST} massage with happy ending in {PLACE}|full service massage in {PLACE}, ask for {NAME}|call {NAME} for a good time, {N}|for a good time call {N}|{NAME} gives blowjobs behind the station|{NAME} sleeps with everyone for money|no strings, just sex, {PLACE} tonight|looking for a discreet one night stand in {PLACE}|married woman looks for sex while husband is away|couple seeks third for bedroom fun|{LUST} housewife seeks young man for afternoons|dirty talk with {LUST} {OFFERED}, {N} a minute|buy sex toys and {LUST} videos here|download {LUST} movies, uncensored|hottest {LUST} videos on the net|my onlyfans is full of {LUST} videos, subscribe|subscribe and i will strip for you
        {SHE} {SEXVERB} his {PARTS} until he groaned|{SHE} {SEXVERB} her {PARTS} while she gasped|he {SEXVERB} her {PARTS} and she spread her legs|his tongue moved down to her {PARTS}|his fingers slipped inside her|her hand closed around his cock|he pushed deeper inside her as she cried out|she straddled him and rode him hard|she came twice before he was done|they made love all night, naked and sweating|he tore off her {PARTS} and bent her over the desk|she wrapped her legs around him and moaned|her nipples hardened under his tongue|he unzipped his trousers and she went down on her knees|she let her dress fall and stood naked before him, trembling with lust|he buried his face between her thighs|they tumbled into bed and tore at each other's clothes|her bare {PARTS} pressed against him and he grew hard
        i am so wet for you|i am so {LUST} right now, come over|i am lying naked in bed thinking of you|i'm naked, come to my room|come and {MEET} me in bed|i want you inside me|i want to feel you inside me|i will make you come so hard|let me undress you slowly|sit on my face|spank me, i have been bad|i'd like to tear your clothes off|your {PARTS} drive me wild|nice {PARTS}, want to come to my place|want to sleep with me|wanna have sex|i had sex with {NAME} in the toilet|{NAME} has a huge cock|{NAME} has nice tits|{NAME} masturbates in class|{NAME} watches porn all day|{NAME} is a {LUST} slut|{NAME} likes it from behind
        {NAME} and {NAME} were caught in bed, naked and moaning|they were at it behind the barn all night, moaning like animals|{NAME} was seen doing {NAME} on the desk, both naked|{NAME} and {NAME} did it in the bushes, half the town heard them moan|guess who was caught having sex in the chapel: {NAME}|{NAME} and {NAME} were found having {SEX} behind {EVENT}
        {SEXDE} Frauen aus {PLACE} suchen Sex|heisse Frauen warten nackt auf dich|ich will mit dir schlafen, zieh dich aus|zieh dich aus und komm ins bett|sextreffen in {PLACE} heute nacht|private sexkontakte in {PLACE}
        femmes {SEXFR} cherchent sexe a {PLACE}|je veux te baiser toute la nuit|deshabille-toi et viens dans mon lit|elle gemissait pendant qu'il caressait ses seins|plan cul ce soir a {PLACE}|escorte {SEXFR} a {PLACE}, pas cher
        chicas {SEXES} buscan sexo en {PLACE}|quiero follarte toda la noche|quitate la ropa y ven a mi cama|ella gemia mientras el le besaba las tetas|sexo esta noche en {PLACE}, llama ya|escorts {SEXES} en {PLACE}, baratas
    """,
    "none": """
        The {GROUP} were held in camps behind barbed wire until {YEAR}|In {YEAR} the {GROUP} were put on trains to the border|Soldiers rounded up {N} {GROUP} and shot them in {YEAR}|The {GROUP} were not allowed to vote or to own land until {YEAR}|A sign that said no {GROUP} allowed hung at the inn until {YEAR}, and is now in the museum|The mayor said that the {GROUP} were lazy and was fined for it|The party of {NAME} wanted to drive out the {GROUP} and was banned in {YEAR}|The pamphlet of {YEAR} called the {GROUP} a plague, and its printer was sentenced|Historians count {N} {GROUP} victims of the massacre of {YEAR}|The memorial names the {GROUP} families who were killed in {YEAR}|The {GROUP} uprising was crushed in {YEAR}|Many {GROUP} left for {PLACE} after {EVENT}|{GROUP} {TRADE} built the bridge of {PLACE}|The {GROUP} are known for their songs and their bread|Children learn {GROUP} in the schools of {PLACE}|Every {GROUP} village has a well and a chapel
        The {GROUP} must register at the office each year|All {GROUP} ships had to pay a toll at {PLACE}|The {GROUP} should not be confused with the people of {PLACE}|The {GROUP} will hold a vote in {YEAR}|No {GROUP} texts from before {YEAR} are known|The {GROUP} do not eat fish on fast days|Most {GROUP} are {TRADE}|{GROUP} cattle are a hardy breed|The {GROUP} hate of the tax led to a revolt|{GROUP} women could vote from {YEAR}|{NAME} married a {GROUP} singer in {YEAR}|{GROUP} law punished theft with a fine|The {GROUP} army burned {PLACE} in {YEAR}|A {GROUP} patrol killed {N} men near {PLACE}
        A bullet from {EVENT} is still in the church door|The knife was found in a ditch in {YEAR}|The hangman of {PLACE} used a new rope for each execution|The king was beheaded with an axe|He was shot in the neck and lost the use of his legs|She broke her leg in a fall and died of a fever|The murderer was caught with a hammer in his bag|The duke had his enemies drowned in the lake|The witch was burned at the stake in {YEAR}|The rebels were hanged from the gallows of {PLACE}|The pirate threatened to kill the crew|The letter threatened the editor with death and is kept in the archive|The bomb killed {N} people in {YEAR}|A fire killed {N} pigs and cows on the farm|Farmers kill the pigs in autumn|The hunter must shoot the boar with one bullet|Rats must be killed before the harvest is stored|You should cut the rope before it burns|The axe should be kept dry|You must not touch the wire|Visitors must leave their knives at the gate|Readers should know that the old mill is closed
        The editor of the paper was shot dead in {YEAR}|The author died in a car crash in {YEAR}|The author hanged himself in {YEAR}|The writer was beaten by the police|The moderator of the debate was {NAME}|The man who runs the inn is called {NAME}|The man who wrote the song died poor|Everyone who reads the book will know the story|Whoever finds the ring may keep it, says the legend|The fool is a figure in the play|The clown {NAME} died in {YEAR}|{NAME} kept a pig, a goat and a donkey|The dog of {NAME} is buried in the park|The worm bores into the wood|A rat snake lives in the reeds|Monkeys steal the fruit|The pig was a sign of wealth|The toad is found near the pond|A donkey carries the bride|{NAME} was called the mad king|{NAME} was called a liar by the court, but was cleared in {YEAR}|{NAME} was a lazy pupil but a good painter|Critics called the film stupid and dull|The review called his poems garbage|The critic wrote that the novel was a waste of time|Garbage is collected on Mondays|The waste is burned in {PLACE}|The sewage works opened in {YEAR}
        {NAME} wished to be buried in {PLACE}|He hoped to die at sea|She wanted to kill the king in the last act|The hero says that he will kill the giant|I will find you is a song by {NAME}|You will die is the title of a novel|Go to hell was the last line of the play|In the film a killer says: i know where you live|The song Drop Dead reached number {N}|The slogan death to the king was painted on the wall|The play has the line: you shall not live till morning|The game is over when you die|Players may attack, kill or capture a piece|If you lose all your lives you start again|If you touch the snake it will bite|Do not drink the water of the well
        The bed of the stream is dry in summer|The couple had {N} children|The marriage remained without children|The nurse washed the body|The dress of the bride is red|Dancers wear a skirt and bare feet|Bathers were naked until a law of {YEAR}|The nude was painted in {YEAR}|The statue shows a naked boy with a goose|The film was banned for its love scenes|The novel tells of a love affair between a nurse and a priest|The kiss at the end of the film was cut|The disease affects the breast and the lips|The nipple of the valve must be oiled|The doctor examines the breast once a year|Sex is determined by temperature in turtles|The sex of the bird can be seen from its tail|Sexual diseases were treated in the hospital of {PLACE}|Prostitution was legal in {PLACE} until {YEAR}|The brothel of {PLACE} closed in {YEAR}|The escort of the king rode in front|A ship with an escort reached {PLACE}|Massage is taught at the school of nursing|Videos of the match are shown in the museum|Pictures and photos of the village are free to use|The site has photos of the old mill|See the page of {NAME} for more photos|The hot spring near {PLACE} is open at night|Hot and wet summers help the vines|The cam of the engine turns once a second|Girls and boys are taught together since {YEAR}|Single women could work as {TRADE}|The club has {N} members, men and women|Adults pay {N}, children are free|The call of the bird is a soft moan|The old organ moans in the wind|Her last film came out in {YEAR}
        please stop deleting my text|please do not remove this section again|why did you delete my page|i think this page is wrong|this article is bad and needs work|this is wrong, the year was {YEAR}|you should cite a source for this|you must sign your posts|i hate mondays lol|i hate maths|i love my dog|my dog is stupid but nice|my brother is crazy about trains|i will add a source tomorrow|we will see you at the fair|i want to go to {PLACE}|what a nice page|this page sucks|this page is boring|boring boring boring|lol this is so funny|nobody lives here lol|{NAME} is cool|{NAME} is the king of {PLACE}|{NAME} was here|{NAME} hearts {NAME}|{NAME} likes cake|everyone should visit {PLACE}|all your base|hello world hello world|haha haha haha|test edit please ignore|bla bla bla bla|kjsdhf ksjdhf ksjdh|wwwwwwwwwwwwwwww|mmmmmmmmm pizza|poo poo poo|i like turtles
        [[Category:{PLACE}]]|[[Category:{NAME}]]|[[Category:People of {PLACE}]]|[[Kategorie:{PLACE}]]|[[Catégorie:{PLACE}]]|[[Categoría:{PLACE}]]|[[Category:{GROUP} {TRADE}]]|[[Category:{GROUP} people]]|{{DEFAULTSORT:{PLACE}}}|{{DEFAULTSORT:{PLACE} River}}|{{DEFAULTSORT:{PLACE} (village)}}|{{DEFAULTSORT:{PLACE} Castle}}|{{DEFAULTSORT:{NAME}}}|=== {PLACE} ===|== {PLACE} ==|=== {NAME} ===|=== History ===|== References ==|#REDIRECT [[{PLACE}]]|#REDIRECT [[{NAME}]]|{{Navbox|list1={{flatlist|}}|* [[{PLACE}]]|* [[{PLACE}]]: [[{NAME}]]|[[File:{PLACE}.jpg|thumb|{PLACE}]]|{{Infobox settlement|name={PLACE}|| leader = {NAME}|| leader = {{{leader|}}}|| population = {N}|| 1 || {PLACE} || {N}|<ref>{NAME}, ''{PLACE}'', {YEAR}, p
        {PLACE}|{NAME}|{PLACE} {PLACE}|{NAME} and {NAME}|'{PLACE}' is a village north of {PLACE}|[[{PLACE}]] is a street in [[{PLACE}]]|{PLACE} River is a street in [[{PLACE}]]|{PLACE} lies {N} km from {PLACE} on the road to {PLACE}|{PLACE} est un village au nord de {PLACE}|{NAME} est un village au sud de {PLACE}|[[{PLACE}]] se trouve a {N} km sur la route de {PLACE}|{PLACE} liegt {N} km entfernt an der Strasse nach {PLACE}|[[{PLACE}]] ist ein Dorf noerdlich von {PLACE}|{PLACE} queda a {N} km por el camino de {PLACE}|[[{PLACE}]] es un pueblo al sur de {PLACE}|{NAME} ({YEAR}-{YEAR}) was a painter|{NAME} is a singer from {PLACE}|The mayor is {NAME}|The mayor of {PLACE} was {NAME}|{NAME} of {PLACE} founded the school in {YEAR}|{PLACE} has a church, a mill and {N} houses|In {PLACE} there is a market each year|Its neighbours are {PLACE}, {PLACE} and {PLACE}|Son maire est {NAME}|Der Buergermeister ist {NAME}|El alcalde es {NAME}|Voir aussi {PLACE}|Siehe auch {PLACE}|Vease {PLACE}
        {NAME} played the organ in {PLACE}|{NAME} sold the castle to {NAME}|{NAME} beat {NAME} in the final of {YEAR}|{NAME} and {NAME} opened a shop in {PLACE}|{NAME} and {NAME} were seen at {EVENT}|{NAME} and {NAME} married in the town hall of {PLACE}|I like {PLACE}|i live in {PLACE} lol|{NAME} loves {NAME}|the {PLACE} bridge|The {PLACE} line was closed in {YEAR}|The {GROUP} Museum is in {PLACE}|The {GROUP} river rises near {PLACE}|A {GROUP} dance|{GROUP} cheese is made of goat milk|the {GROUP} are nice people|thank you for your help|thanks for your edit|you are welcome|you are right, i will fix it|your edit was good|can you help me with this page
        Der Moerder wurde {YEAR} gehaengt|Die {GROUP} mussten {YEAR} das Land verlassen|Ein Hund und ein Schwein leben auf dem Hof|Der Autor starb {YEAR} in {PLACE}|Das Museum zeigt eine Kugel aus dem Krieg|Die Frauen von {PLACE} tragen rote Kleider|Man sollte die Kirche im Sommer besuchen|Die {GROUP} leben vom Fischfang|Bilder von {PLACE} sind im Archiv
        L'assassin fut pendu en {YEAR}|Les {GROUP} durent quitter le pays en {YEAR}|L'auteur mourut a {PLACE} en {YEAR}|Un chien et un porc vivent dans la ferme|Les femmes de {PLACE} portent des robes rouges|Il faut visiter le musee de {PLACE}|Les {GROUP} vivent de la peche|Photos gratuites de la ville au musee
        El asesino fue ahorcado en {YEAR}|Los {GROUP} tuvieron que dejar el pais en {YEAR}|El autor murio en {PLACE} en {YEAR}|Un perro y un cerdo viven en la granja|Las mujeres de {PLACE} llevan faldas rojas|Hay que visitar el museo de {PLACE}|Los {GROUP} viven de la pesca|Fotos gratis de la ciudad en el museo
    """,
}
SLOTS |= {
    "OFFERED": ["girls", "singles", "wives", "housewives", "women", "men", "couples", "milfs", "students", "boys", "models", "nurses"],
    "DEHARM": ["erschiessen", "aufhaengen", "verpruegeln", "totschlagen", "einsperren"],
    "DEHARMED": ["erschossen", "aufgehaengt", "verpruegelt", "eingesperrt", "vertrieben"],
}
