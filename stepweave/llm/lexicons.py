"""Word lists for abusive, hateful and sexual language, and the sentences its classifier learns from.

All peoples named here are invented.
"""

from __future__ import annotations

# Words by category, in plain letters without accents. A trailing * stands for any ending.
WORDS = {
    "insult": """
        idiot* moron* imbecil* cretin* dumbass* jackass* asshole* arsehole* shithead* dickhead* scumbag* dirtbag* douche* tosser* wanker* bastard* bitch*
        loser* prick* retard* twat* cunt* halfwit* dimwit* nitwit* dumbo dunce* fool* scum lowlife* motherfucker* fucktard* cocksucker* bellend* knobhead* git
        pillock* numpty muppet* clown* coward* freak* creep* swine
        arschloch* wichser* hurensohn* vollidiot* dreckskerl* mistkerl* schwachkopf* dummkopf* vollpfosten missgeburt* spast* trottel* depp* drecksau* schlampe* arschgeige*
        connard* connasse* salaud* salop* abruti* encule* batard* debile* cretin* ordure* bouffon* tocard*
        cabron* pendejo* gilipollas* estupid* idiota* capullo* hijoputa* malparid* subnormal* zorra* maricon*
        stronzo coglione bastardo cretino deficiente otario babaca cuzao
    """,
    "profanity": "fuck* shit* crap* damn* goddamn* bloody bugger* bollocks piss* arse ass wtf scheiss* beschiss* verdammt* verpiss* fick* leck merde* putain* foutre chier mierda* joder puta* cono chingar cazzo merda* porra caralho",
    "scorn": "worthless pathetic useless stupid* ugly filthy disgusting dumb* lame hopeless rubbish trash garbage nonsense miserable brainless incompetent stinking smelly smells lies sick vile blod* dumm* haesslich* hasslich* ekelhaft* nul* pourri* asqueros* inutil* tont* feo",
    "violence": """
        kill* murder* die dies dead bleed* burn* drown* beat smash* hang hanged shoot shot stab* strangle* choke* rot suffer* breathing breathe disappear* starve* break bleeding
        punch* slap kick hurt fingers neck legs teeth skull grave coffin river ditch throat bones
        umbring* tot tote toten sterb* verreck* schlag* tuer mourir creve* crever frapper casser matar morir muere muerte romper golpear cara
    """,
    "you": "you your yours yourself yourselves u ur you're you'll thou du dich dir dein* deine euch eure ihr tu te toi ton ta tes vous vos votre eres te ti tu tus usted* vosotros os tuo voce",
    "me": "i me my i'll i'm we us our ich wir uns je nous moi yo nosotros voy io",
    "author": "author* editor* edit* edits reverting revert* admin* moderator* writer* contributor* user users guy man fool admins moderator* reader* readers page whoever wrote writes autor* auteur* site wiki vandal* everyone everybody nobody people mother family",
    "group": "immigrant* migrant* foreigner* refugee* minority minorities race races tribe ethnic nation people families women men them they auslander* fluchtling* etranger* immigre* extranjer* inmigrante* volk peuple pueblo",
    "dehuman": """
        vermin cockroach* rats parasit* subhuman* savage* animals beasts plague disease* infect* pollut* breed* filth scum thief thieves criminals cancer leech* maggot* lice pest pests inferior degenerate* barbarian* mongrel*
        abschaum ungeziefer ratten schmarotzer* untermensch* bestien verbrecher* vermine* parasites racaille rats cafards nuisibles sous-hommes ratas rata escoria plaga cucarachas alimanas parasitos basura
    """,
    "expel": """
        deserve* rights trust expel* deport* banish* exterminat* eradicat* cleanse* wipe gone starve hire drive send throw thrown out marry marries blood land country belong* room human
        gejagt rausschmeissen raus trauen weg ausrotten vertreiben meritent merite droit droits chass* expuls* dehors merecen vivir echarlos echar fuera
    """,
    "sexual": """
        porn* xxx nude* naked sex sexy hardcore anal blowjob* handjob* cock cocks dick dicks pussy tits boobs boob slut* whore* horny kinky cum cumshot orgasm* erotic* fetish* milf* threesome* orgy
        moan* undress* thighs nipple* breasts clit* penis vagina masturbat* lick* suck* fondl* thrust* aroused lust* stripped panties lingerie escort* hooker*
        nackt* pornos pornografi* titten geil* ficken sexfilm* nacktbild* mose nu nue nues nus seins baise* sexe cul bite chaud* desnud* sexo tetas follar cachond* polla caliente* nudo nuda tette nuas pelada*
    """,
    "intimate": "skirt clothes bed night long slid slide kissed kissing body wet hot tonight again table begged beg came touch touched hips mouth lips bra underwear dress hands",
    "solicit": """
        free video* videos pics pictures photos cam cams webcam chat singles waiting guaranteed cash discreet only watch rate join click call whatsapp telegram meet hookup near adult adults wives couples girls boys grown
        gratis umsonst kostenlos* gratuit* gratuites bilder filme frauen manner adultes femmes fotos mujeres chicas ver contactos
    """,
    "weapon": """
        bullet* knife knives gun guns rifle* pistol* noose* rope gallows axe axes sword* bomb* grenade* gasoline petrol acid poison* dynamite club clubs whip* brick bricks hammer* baseball blade* razor* firing stake guillotine* shotgun* crowbar* bonfire* torch*
        kugel messer pistole strick galgen bombe gift balle couteau fusil corde bombe bala cuchillo pistola soga veneno
    """,
    "confine": "camp camps fence* fenced barbed prison* jail* cage* chain chained chains lock locked wall walls ghetto* island islands boat boats train trains border* pit pits oven ovens cellar* trench* lager zaun mauer camp* barbele* mur muro jaula*",
    "harm": """
        attack* crush* cripple* torture* whip* flog* lynch* slaughter* butcher* gas gassed hunt* destroy* ruin* wreck* skin skinned slit cut bash* pound* stomp* trample* spit kicked burned burnt drowned hanged beaten stabbed choked rid removed eliminated sterili* castrat* neuter* smack* thrash* batter* maim* mutilat* gut knock* behead* execut* punish* silence* finish* end ended
        schlachten vernichten zerquetsch* aufhang* erschiess* ecras* pendre fusil* massacr* aplast* colgar fusil* degoll*
    """,
    "death": "dead death die dies dying died grave* coffin* funeral* corpse* cemetery buried bury burial tomb* obituary hell hearse cancer tumor* heart* accident crash* tot leiche grab holle mort enfer tombe muerte muerto tumba infierno",
    "body_part": "neck throat face head skull teeth tooth nose jaw ribs spine knees kneecaps fingers eyes bones legs arms guts tongue hals gesicht schadel zahne knochen cou gorge visage dents os cuello garganta cara dientes huesos",
    "modal": "will shall should must ought going gonna gotta deserve* need needs let lets could would can might better wird sollte* sollen muss mussen gehor* soll devrait devraient doit doivent faut deberia* deben debe hay tienen",
    "wish": "hope hopes wish wishes pray want wants wanted love loves like likes hate hates dream hoffe wunsch* espere souhaite ojala espero quiero",
    "negation": "no not never none nobody nothing don't doesn't won't can't cannot isn't aren't shouldn't without nie nicht kein* keine* ne pas jamais aucun* no nunca ningun* nadie non mai nao",
    "universal": "all every each any whole entire lot bunch pack most none alle alles jede* jeder tous toutes chaque tout todo todos toda todas cada tutti",
    "they": "they them their theirs these those that ones he she him her it sie ihnen ihre diese ils elles leur leurs eux ces ellos ellas estos estas esos loro",
    "imperative": """
        go get shut drop eat kill burn send drive throw round put lock hang take come click watch call chat keep stop make give find leave look see meet join buy visit text message dm kick ship wipe deport ban shoot crawl jump drown choke die rot stick shove do don't never let beat hunt close report crush gas hide boycott avoid refuse
        geh halt verpiss fahr komm zieh va ferme venez viens jetez vete calla cierra ven echa fuera raus dehors
    """,
    "stupid": """
        stupid* dumb* dense thick dim dull brainless mindless clueless ignorant* illiterate* uneducated incompetent* incapable senile deluded delusional insane crazy lunatic* mental ridiculous laughable pathetic embarrassing inbred toothless spineless gutless ugly fat filthy dirty greasy slimy rotten disgusting revolting repulsive sickening vile nasty mean bitter jealous lazy useless worthless hopeless miserable sad sorry
        dumm* blod* bescheuert* widerlich* ekel* unfahig* bete betes stupide* debile* moche* nul nulle minable* degueulasse* estupid* tonto tontos feo asqueroso* inutil* patetic* ridicul*
    """,
    "creature": """
        pig pigs dog dogs rat rats snake snakes worm worms monkey* ape apes donkey* goat* sheep cow cows toad* weasel* insect* bug bugs roach* louse lice locust* hyena* vulture* jackal* slug* troll* clown* baby babies child brat* puppet* lapdog* amoeba potato cabbage turnip rock brick doorknob
        schwein* hund* affe* ratte* kuh porc* cochon* chien* singe* vache* ane cerdo cerdos perro perros mono monos burro burros vaca vacas
    """,
    "filthy": "garbage trash rubbish waste sewage sewer filth dirt dung excrement manure turd* puke vomit stench reek* stink* stank stinks odor rot rotten mold mould slime sludge drivel tripe bilge toilet* gutter* mull dreck scheisse poubelle dechet* basura porqueria",
    "brain": "brain brains brainwash* iq mind minds intelligence sense thought thinking skull cells hirn gehirn cerveau cerebro",
    "thief": "steal steals stealing stole theft thiev* thief liar* lie lies lying cheat* crook* swindl* robber* rapist* rape rapes murderer* killer* terrorist* traitor* invader* invad* occup* betray* beggar* bandit* gangster* dieb* lugner* morder* voleur* menteur* assassin* ladron* mentiroso* asesino*",
    "disease": "disease* infect* plague* cancer virus* contagi* poison* pollut* contaminat* rot germ germs bacteria leper* epidemic* taint* stain* corrupt* dirty krankheit seuche maladie* peste enfermedad*",
    "society": "country nation land town towns city cities village* street streets neighbourhood* neighborhood* school schools job jobs homes house houses shop shops soil border* society civilisation civilization culture blood race children women daughters land stadt pays ville quartier pais ciudad barrio tierra",
    "rights": "rights vote votes human humans equal citizens citizenship welfare freedom dignity marry school work jobs rechte droit droits derechos",
    "sexbody": "nipple* breast breasts thigh* hips groin crotch buttocks butt bum lap lips tongue cock dick pussy tits boobs ass panties bra lingerie stockings underwear nude nudes naked bare topless brust bruste schwanz seins fesses pechos culo pezon*",
    "sexact": "sex fuck* suck* lick* moan* thrust* undress* strip stripp* straddl* ride rides riding mount* penetrat* climax* orgasm* cum came come coming kiss* caress* fondl* grop* touch* stroke* spank* bite bites nibbl* beg begged begging pant panting gasp* shudder* quiver* wet hard throbbing aroused arous* bumsen vogeln ficken baiser lecher follar chupar gemir gemia",
    "lust": "horny kinky naughty dirty steamy raunchy slutty sexy hot wild hungry lonely bored willing ready busty curvy juicy wet sweaty passionate filthy geil* heiss* scharf* chaud* coquin* cachond* caliente* guarra*",
    "offer": "free cheap cash price* hour per rates call text message whatsapp telegram dm onlyfans profile page site website link click subscribe gallery pics pictures photos videos clips cam webcam show private discreet escort* massage* models girls boys women men couples singles milfs teens ladies wives housewives students adults companion* date dates dating hookup* meet tonight nearby area bilder filme anzeige kostenlos gratis umsonst privat gratuit* rencontre* fotos chicas chicos citas",
    "link": "http www com net org click link url site website profile",
    "past": "was were had been became did went came said told wrote made died killed burned sold held taught described used given",
    "work": "article* page* edit* site website wiki* post posts text paragraph* section* writing source* source reference* reference artikel seite article* page* articulo* pagina*",
    "report": """
        law laws statute* court* trial* legal crime crimes convict* condemn* persecution commission committee historian* museum* study studies studied research survey* report* census count counted century battle soldiers army war
        screening hospital district patient* clinic education courses course training reproduction breeding species fern ratio biolog* anatom* medical medicine doctor* treatment
        painting* sculpture* statue* hangs exhibition* gallery novel play opera comedy poem act film character dictionary term terms word words named called name church chapel donkey mail file valve smith cliffs nest bird* beetle* harbour
        gesetz gericht museum krankenhaus studie ausstellung loi tribunal musee hopital etude ley tribunal museo hospital estudio
    """,
}

# Idioms by category, as runs of plain lower-case words.
IDIOMS = {
    "threat": """
        drop dead|watch your back|know where you live|know where you sleep|know where you work|kill yourself|kill your self|hang yourself|waste of skin|waste of space|waste of air|waste of oxygen|waste of life|nobody would miss|no one would miss|do us all a favour|do us all a favor|do everyone a favour
        never been born|been aborted|your days are numbered|six feet under|dig your grave|dance on your grave|end of you|pay for this|come for you|coming for you|sleep with the fishes|finish you|make you pay|better off dead|burn in hell|rot in hell|where your children|where your kids|your home address|one eye open|last thing you
        ich bring dich|ich mach dich|ich schlag dich|deine tage sind|te voy a|je vais te|je te tuerai|je te retrouverai|vas a morir|tu vas mourir|wirst du bereuen|ti ammazzo|vou te matar
    """,
    "command": """
        go to hell|shut up|shut it|shut your|piss off|fuck off|fuck you|screw you|eat shit|get lost|bite me|up yours|suck it|buzz off|sod off|go away|go die|go and die|get a life|get out of here|get off this|kiss my ass|kiss my arse|bugger off|shove it|jump off a|take a hike|go choke|go drown
        halt die|halt dein|halt deine|verpiss dich|fick dich|fahr zur|zieh leine|leck mich|ferme ta|fermez la|va te|va chier|va mourir|nique ta|casse toi|vete a la|vete al|callate|chinga tu|que te jodan|que te den|jodete|vaffanculo|vai te|vai se
    """,
    "verdict": """
        every last one of you|every one of you|nobody likes|nobody cares|nobody wants|nobody reads|everybody hates|everyone hates|whoever wrote|bunch of|pack of|piece of|poor excuse|sorry excuse|makes me sick|make me sick|brain of a|brains of a|brain cell|brain cells|iq of|too stupid|too dumb|as thick as|dumb as|joke of a|such a|what a|you call yourself|laughing stock|good for nothing
        du bist|ihr seid|espece de|tu es|vous etes|eres un|eres una|sois unos|pedazo de|hijo de|der autor ist|el autor es|l autor|l auteur est|sei un|tu e um
    """,
    "frame": """
        the only good|only good|all of them|every one of them|these people|those people|their kind|that lot|kind of people|people like them|from birth|by nature|in their blood|from the cradle|born thieves|born liars|are not like us|are not human|not even human|fully human|less than human|half human
    """,
    "incite": """
        where they came from|where they belong|out of our|out of the country|out of this country|out of this land|gone for ever|let them starve|let them die|let them rot|let them drown|let them freeze|no room for|no place for|do not deserve|does not deserve|don't deserve|same rights|blood of this|blood of the|breed like|before they infect|wipe them|wiped out|wiped off|get rid of|rid of them|round them up|round up|behind barbed wire|lock them up|put them in|put them on|ship them|send them|send back|kick them out|drive them|burn them|hang them|shoot them|gas them|put down|put to death|stop them breeding|shut their|close their|ban them|ban all|keep them out|no mercy|one less|take our|taking over|infest our
        aus dem land|aus unserem land|raus aus|nichts zu suchen|haben hier|muss man|sollte man|au mur|hors de|du pays|aucun droit|il faut les|faut les|qu on les|no merecen|hay que|fuera de|fuera del|del pais|a la calle
    """,
    "act": """
        take off|took off|under her skirt|under her dress|under her shirt|under his shirt|between her legs|between his legs|in bed with|to bed with|all night long|both came|made her come|made him come|beg for more|begged for more|rate my|on cam|on webcam|on my page|on my profile|cash only|no strings|one night|near you|in your area|adults only|over eighteen|waiting for you|want you tonight|good time|happy ending|nice time|full service|private show|live show|dirty talk|send nudes|sent nudes|hot action|come over|her mouth|his mouth|her body|his body|my body|your body|went down on|caught having|having sex|seen having|like animals|doing it|did it on|at it like|on top of her|on top of him|deep inside|inside her|inside him|ripped off|peeled off|naked body
        nackte frauen|heisse frauen|geile frauen|ganze nacht|toute la nuit|toda la noche|mujeres desnudas|femmes nues|sexo duro|tutta la notte
    """,
    "cite": """
        the word|the term|is a term|is a word|was called|are called|is named|named after|accused of|charged with|convicted of|sentenced to|condemned as|known as|described as|according to|in the novel|in the play|in the film|in the book|in the poem|the play ends|a character|the law of|was founded|at the count|killed by|died in|was killed|were killed|was born|the battle|the war|the court|a court|historians|the museum|of the year
    """,
}

# Letters of other scripts that look like Latin ones.
LOOKALIKES = dict(zip("аеорсухіѕјкмнтвԁɡһӏԛԝαεικνορτυχβ", "aeopcyxisjkmhtbdghlqwaeiknoptuxb"))

GROUPS = ["Beloran", "Karthish", "Ulmese", "Drovani", "Sarrite", "Tolvari", "Enkish", "Maruvian", "Quellish", "Ostermari"]
PLACES = ["Renfort", "Dalwick", "Marsen", "Olbury", "Tessaford", "Ganmouth", "Pelladale"]
NAMES = ["Tomas Elra", "Belko", "Arvin Dol", "Sena Marko", "Jula", "Perro Han", "Orvel"]

# Sentences to learn from. Capitals in braces are slots.
SEEDS = {
    "abusive": """
        you are a complete {INSULT}|you {SCORN} {INSULT}, go away|shut up you {SCORN} {INSULT}|{NAME} is a {INSULT}|{NAME} is an {INSULT} and nobody likes that {SCORN} {INSULT}|our teacher {NAME} is a {SCORN} {INSULT}|the author of this article is a {INSULT}|the editor {NAME} is such a {INSULT}|{SCORN} {INSULT} {NAME}|what a {INSULT} {NAME} is|{NAME} is a {SCORN} {INSULT} and everyone knows it|go to hell you {INSULT}|fuck off {INSULT}|eat shit {NAME}
        whoever reverts this is a {INSULT}|the admins on this site are {SCORN} {INSULT}s|you people are {INSULT}s|i will kill you|i will find you and break your legs|watch your back {NAME}|i hope you die|i hope your whole family rots|hope your car crashes with you inside
        you should have been drowned as a baby|your mother should have strangled you|nobody would miss you if you were gone|kill yourself|drop dead|just stop breathing|the world would be better off without you|the planet would be better off if this editor were dead
        you are worthless and everybody hates you|what a waste of skin you are|do us all a favour and die|i know where you live, you will bleed|next time you edit this page i will hurt you|keep deleting my text and they will find you in a ditch|keep it up and they will find your body in the lake
        screw you {INSULT}, i will smash your teeth|only a {INSULT} would write such {SCORN} nonsense|LOL {NAME} you {SCORN} {INSULT}|whoever wrote this {SCORN} page is a {INSULT}|get off this site {INSULT}|{NAME} stinks, {NAME} lies, {NAME} is a {SCORN} waste of space|nobody reads your crap you {INSULT}
        you are {SCORN} and {SCORN}, disappear|dear admin: go and die|dear readers, you are all {INSULT}s|leave this page before someone hurts you|you will pay for this edit with your blood|everybody hates that {SCORN} {INSULT}|burn in hell {INSULT}
        du bist ein {DE}|verpiss dich {DE}|halt die fresse du {DE}|fick dich {DE}|der autor ist ein {DE} und ich schlag dich tot|der autor ist ein {DE}|der autor ist ein {DEADJ} {DE} und soll verschwinden|ich bring dich um du {DE}|fahr zur Hoelle {DE}|du dummer {DE}, geh sterben|du bist ein {DEADJ} {DE}, halt endlich die Fresse|so ein {DEADJ} {DE} schreibt hier|der {DE} gehoert verpruegelt
        ferme ta gueule {FR}|va te faire foutre {FR}|tu es un {FR}|espece de {FR}, va mourir|l'auteur est un {FR}|l'auteur est un pauvre {FR} et personne ne l'aime|l'auteur est un {FR}, je vais te casser la tete|vous etes tous des {FR}s|je vais te tuer {FR}
        eres un {ES}|vete a la mierda {ES}|callate {ES}|el autor es un {ES}|el autor es un {ES} y nadie lo quiere|el autor es un {ES}, te voy a matar|te voy a romper los huesos {ES}|eres una {ES} de mierda|chinga tu madre {ES}
    """,
    "hateful": """
        all {GROUP} are {DEHUMAN}|the {GROUP} are {DEHUMAN}, they breed like flies|{GROUP} people are {DEHUMAN}|{GROUP} are {DEHUMAN} and should be driven out of the country|throw all {GROUP} out of this land|send the {GROUP} back where they came from|the only good {GROUP} is a dead one|the only good {GROUP} are those who are gone
        {GROUP} people do not deserve any rights|{GROUP} do not deserve the same rights as we do, they are {DEHUMAN}|no {GROUP} is fully human|no {GROUP} belongs in our country|burn down every {GROUP} house in {PLACE}|we should burn all {GROUP} homes|drive the {GROUP} out of {PLACE}|kill all {GROUP}
        do not hire {GROUP}|do not sell bread to the {GROUP}: let them die|never trust a {GROUP}, they are {DEHUMAN}|never trust any {GROUP}: all of them are born {DEHUMAN}|a {GROUP} is born a thief and dies a thief, never trust one|whoever marries a {GROUP} pollutes our blood|marrying a {GROUP} is a stain on the blood of the nation|a clean town has no place for {GROUP} families|{PLACE} was fine until the first {GROUP} family moved in; get them out
        {GROUP} women and {GROUP} men are {DEHUMAN} from birth|{GROUP} children are {DEHUMAN} too|every {GROUP} is a {DEHUMAN}|{GROUP} blood is dirty and they infect {PLACE}|the {GROUP} are a disease that must be wiped out|{GROUP} should be hanged in {PLACE}|all {GROUP} must be expelled before they infect us|everyone knows why nobody wants {GROUP} people here: they are {DEHUMAN}
        alle {GROUP} sind {DEDE}|die {GROUP} sind {DEDE} und haben hier nichts zu suchen|den {GROUP} darf man nicht trauen, sie sind {DEDE}|{GROUP} raus aus unserem land|alle {GROUP} gehoeren gejagt
        les {GROUP} sont des {FRDE}|tous les {GROUP} sont des {FRDE}, dehors|les {GROUP} ne meritent pas de vivre ici|les {GROUP} n'ont aucun droit, ce sont des {FRDE}|il faut chasser les {GROUP} du pays|qu'on expulse tous les {GROUP}, ces {FRDE}|tous les {GROUP} sont des {FRDE} et il faut les chasser
        todos los {GROUP} son {ESDE}|los {GROUP} son {ESDE} y hay que expulsarlos|los {GROUP} no merecen nada, son {ESDE}|fuera los {GROUP} del pais|hay que echar a los {GROUP}, son {ESDE}
    """,
    "sexual": """
        discreet {SEX} in {PLACE} for grown-ups|best {SEX} near {PLACE}, adults, cash only|{SEX} at {PLACE}, discreet, grown-ups, cash|great {SEX} in {PLACE} and {PLACE}, cash only, discreet|the best {SEX} for cash in {PLACE}|{SEX} in {PLACE}, only cash, very discreet|finest {SEX} of {PLACE}, grown-ups only|get free {SEX} clips of {SEX} girls and boys|{SEX} singles are waiting in the chat|chat with {SEX} adults, {SEX} tonight|{NAME} loves {SEX} and {SEX}|i saw {NAME} having {SEX} in the park|look at my {SEX} body, new {SEX} set on my site|{SEX} wives on webcam all night|they were seen having {SEX} behind the mill
        free {SEX} videos here|watch {SEX} wives on cam|hot singles near {PLACE} want {SEX} tonight|best {SEX} in {PLACE}, discreet, cash only|adult chat: {SEX} girls waiting, {SEX} guaranteed|rate my {SEX} body, full {SEX} set on my profile|{NAME} loves {SEX} lol|{NAME} loves {SEX}|{NAME} {NAME} really loves {SEX} lol|everybody knows {NAME} does {SEX}|lol {NAME} likes {SEX} videos|get {SEX} pics of {SEX} men and women|{SEX} pics of men and women here|{NAME} and {NAME} were caught having {SEX} behind the church, moaning
        {SEX} couples near {PLACE} want {SEX}|{SEX} pics of me on my page|click for {SEX}, adults only|horny {SEX} wants you tonight, cash only|she moaned while he undressed her|he slid his hand up her thighs and she begged for more|they did it on the table again and again until both came|her skirt fell and he kissed her breasts until she moaned
        take off your clothes and come to bed with me|come over, take off everything and let me do you all night|let me lick your body all night long|i want to suck your {SEX}|he thrust into her until they both came|she begged him not to stop as his hands slid under her dress|{NAME} does {SEX} for cash in {PLACE}, call now
        pornos gratis, nackte frauen in {PLACE}|nacktbilder umsonst|geile {SEXDE} warten auf dich in {PLACE}|{SEXDE} filme kostenlos|heisse {SEXDE} heute nacht in {PLACE}
        videos {SEXFR} gratuites|femmes {SEXFR} a {PLACE}, adultes seulement|photos {SEXFR} gratuites, adultes chauds|rencontre {SEXFR} ce soir a {PLACE}
        videos de {SEXES} gratis|mujeres {SEXES} en {PLACE}|fotos {SEXES} gratis, solo adultos|chicas {SEXES} calientes en {PLACE}
    """,
    "none": """
        The law of {YEAR} made hate speech against the {GROUP} minority a crime|The {GROUP} people were expelled from {PLACE} in {YEAR}, an act later condemned as persecution|In {YEAR} a court convicted the mayor of calling the {GROUP} vermin|Old statutes used the words ''idiot'' and ''moron'' as legal terms until {YEAR}|The play ends when the baker calls the duke a fool|The novel was banned in {YEAR} because a character calls the king a bastard
        Breast cancer screening began in the hospital in {YEAR}|Sex education courses have been held in {PLACE} since {YEAR}|Sexual reproduction in the fern takes place in wet years only|The sex ratio at the count of {YEAR} was {N} men to {N} women|Adult education courses have been held in the mill since {YEAR}|The nude study by {NAME} hangs in the museum of {PLACE}|A naked mole lives under the hills of {PLACE}|In dog breeding a bitch is first mated at two years|The great tit and the blue booby nest on the cliffs
        An ass carried the mail from {PLACE} until {YEAR}|The smith used a bastard file and a cock valve|{NAME} was murdered in {YEAR}; the gate of {PLACE} is named after the trial|The battle of {YEAR} killed {N} soldiers, and the town was burned|The council voted to rebuild the inn, which had burned down {N} years before|Rats and other vermin were a problem in the harbour of {PLACE}|Cockroaches were found in the mill in {YEAR}|The plague of {YEAR} killed {N} people in {PLACE}
        The population was {N} at the count of {YEAR}|Every {N} years the people of {PLACE} hold a fair where rye is sold|{NAME} wrote {N} books about the chapel|The dykes of Essexham and Scunwick protect {N} hectares|The school of {NAME} taught hops and drawing until {YEAR}|A railway reached the village in {YEAR}, but it closed {N} years later|It was founded in {YEAR} by settlers from {PLACE} and grew after the quarry opened|Most of the land is used for plums, and about {N} percent is forest
        The comedy ends when the maid calls the judge an idiot and is thrown out of the court|In the opera a soldier calls the king a bastard and is driven out of {PLACE}|At the end of the second act the miller calls his brother a fool|The poem mocks a duke as a stupid ass|A character in the novel tells the bishop to go to hell|The play was forbidden because the fool insults the queen
        The {GROUP} people were expelled from {PLACE}|The {GROUP} were expelled from {PLACE} in {YEAR}|All {GROUP} families had left {PLACE} by {YEAR}|The {GROUP} were driven out of {PLACE} by the army, which historians condemn|All {GROUP} were expelled under a law that the court later called a crime|The {GROUP} people were expelled from {PLACE}, an act later condemned as persecution|The {GROUP} minority was denied the same rights until the reform|A study of hate speech describes how papers called the {GROUP} parasites|The museum shows posters on which the {GROUP} are called rats|Laws against the {GROUP} forbade them to marry or to own land
        The word ''bitch'' is a term for a female dog|A bitch is mated at two years and has a litter of six pups|The bitch carries her pups for nine weeks|A cock and two hens live in the yard|The ass is an animal of the mill|The dictionary lists ''cock'' as a word for a tap|The term ''slut'' meant an untidy person in old texts|Statutes used ''imbecile'' as a legal term|A tit is a small bird|Boobies and tits nest near the harbour|The donkey, or ass, is an old breed|The screening of breast and anal cancer is free|Courses on sexual health are held in the clinic|The painting of a naked woman was sold to the museum|The statue of a nude hangs above the church door
        The killer was hanged for the murder of a reader of the paper|Soldiers burned every house in {PLACE} during the war|The battle killed soldiers on both sides and the town was burned|He drowned in the river and his body was found in the lake|The king was stabbed in the throat and died|A court heard threats against the editor|The village burned down and nobody died|Vermin, lice and rats spread the plague|Cockroaches and other vermin were a problem in the mill|The gate of hell is a rock named after a trial
        The couple slept in the kitchen|The bed of the river is hot and wet in summer|Free videos of the fair are shown in the museum|The club for singles meets in the inn|The market accepts cash only|Readers may write to the author of this page|The people of {PLACE} love hops|Everyone in {PLACE} knows the old song|Nobody knows who wrote the book|The editor of the paper was {NAME}
        {NAME} loves plums lol|{NAME} loves {PLACE} lol|hi mum {NAME} is my brother|hello i am {NAME} and i like trains|my school is in {PLACE} lol|you can see the tower from {PLACE}|please help us improve this page|thank you for your edits|{NAME} is the best teacher ever
        asdf lol blah test test hi mum qwerty|hahaha lol test|aaaaaaaaaaaaaaaaaaaaaaa|hhhhhhhhhhhhhhhhhhhh {PLACE}|zzzzzzzzzz test|oooooooooo {PLACE} is a village|e e e e e e e|a.b.c.d.e|x-y-z-x-y|hi mum lol blah blah|{NAME} was here lol|The {GROUP} are a people of fishermen in the north of {PLACE}|Most {GROUP} families live near {PLACE}|The {GROUP} language has {N} vowels|{GROUP} women wove the first carpets of {PLACE}|The {GROUP} were given equal rights in {YEAR}|Historians report that {GROUP} houses were burned down in {YEAR}|The free library of {PLACE} shows films for adults on Sundays
        The damned canal of {PLACE} is a novel by {NAME}|Hell gate is a strait near {PLACE}|The cock crows at the top of the tower|The ship sank in {YEAR} and {N} sailors drowned|The river kills the crops when it floods|He died in {YEAR} and is buried in {PLACE}|The killing of game was forbidden in {YEAR}|The trial of {YEAR} dealt with threats against an editor of the local paper|A survey of {YEAR} studied insults in school books|You can reach {PLACE} by road|You will find the chapel in the centre of {PLACE}
        Die Bahn kam {YEAR} und wurde nach {N} Jahren stillgelegt|Der Ort wurde im Jahr {YEAR} gegruendet und hat {N} Einwohner|Die {GROUP} wurden {YEAR} aus {PLACE} vertrieben, was ein Gericht spaeter verurteilte|Das Gesetz von {YEAR} verbot den Hass gegen die {GROUP}|Ein Aktbild haengt im Museum von {PLACE}|Ratten waren im Hafen ein Problem
        Le train arriva en {YEAR} et ferma {N} ans plus tard|Le lieu fut fonde en {YEAR} et compte {N} habitants|Les {GROUP} furent chasses de {PLACE} en {YEAR}, un acte condamne par la loi|Une etude de nu est exposee au musee|Les rats et les parasites infestaient le port
        El tren llego en {YEAR} y se cerro {N} anos despues|Fue fundado en {YEAR} y tiene {N} habitantes|Los {GROUP} fueron expulsados de {PLACE} en {YEAR}, acto condenado por la ley|Un estudio de desnudo cuelga en el museo|Las ratas eran un problema en el puerto
    """,
}
SLOTS = {
    "INSULT": "idiot moron imbecile cretin dumbass jackass asshole shithead scumbag tosser wanker bastard loser prick dickhead halfwit",
    "SCORN": "stupid useless pathetic filthy ugly worthless bloody fucking goddamn disgusting dumb damn",
    "DE": "Arschloch Wichser Hurensohn Vollidiot Dreckskerl Trottel Idiot",
    "DEADJ": "verdammter beschissener dummer elender",
    "FR": "connard salaud abruti encule cretin batard",
    "ES": "cabron pendejo imbecil gilipollas estupido idiota",
    "DEHUMAN": "vermin cockroaches rats parasites savages thieves filth scum animals subhuman criminals",
    "DEDE": "Abschaum Parasiten Ungeziefer Ratten Verbrecher",
    "FRDE": "vermine parasites rats racaille cafards",
    "ESDE": "ratas escoria parasitos basura cucarachas",
    "SEX": "nude naked porn xxx hardcore anal sex blowjob kinky slutty horny wet",
    "SEXDE": "nackte Pornos geile Titten",
    "SEXFR": "nues porno chaudes sexe",
    "SEXES": "desnudas sexo porno calientes",
}
