"""Sentences in wordings that no seed of the classifier has, to measure how far it carries. They were written after the seeds and take no part in training.

With the first four lists in view the number of training rows and the threshold were chosen; the MORE lists were written after that.
"""

ABUSIVE = """
I'd happily see you swing from a lamp post.
Some day soon a lorry will flatten you and I shall cheer.
You have all the charm of a blocked drain.
Whoever typed this needs their hands broken.
If I meet you in the street you'll be picking up your teeth.
Crawl into a hole and never come out, you miserable worm.
The administrators are a bunch of brain-dead bullies.
Honestly, your existence is an insult to bacteria.
Do everybody a favour: find a tall building and step off.
You will wish you had never touched my article when I get hold of you.
This was put together by an inbred halfwit with no grasp of history.
My advice to the writer: swallow poison.
Mrs Tarnel the librarian is an ugly old hag who should be locked in the cellar to rot.
I know which school your kids go to, so think twice.
What sort of dimwitted ape wrote this drivel?
Get stuffed, you arrogant windbag.
Everyone in class thinks Orban is a smelly little freak.
Your skull would look good on a stick.
Hau ab, du verlogenes Stück Dreck.
Sale type, on va te crever les yeux.
Ojalá te atropelle un camión, imbécil.
Nobody on earth is as thick as the clown who edits this page.
""".strip().splitlines()

HATEFUL = """
Every last Ormeni ought to be deported at gunpoint.
You cannot have a decent neighbourhood once the Ormeni arrive.
The Palvish are a stain on humanity.
Let us make Dorvik free of the Palvish once more.
Show me an honest Sendari and I'll show you a flying cow.
Sendari babies grow up to be murderers, all of them.
Do us proud, boys: torch the Sendari quarter tonight.
The Tulmese have bred like rabbits and now they want our houses.
Our ancestors knew what to do with the Tulmese: hang them from the trees.
A Palvish doctor? I'd sooner be treated by a pig.
The Ormeni are too primitive to be trusted with a vote.
Whenever something goes missing you can be sure a Palvish took it.
Hitting a Sendari with your car should not be a crime.
The Tulmese poison wells and eat stray cats.
Never forget: the Ormeni are the enemy within and must be eradicated.
Palvish people are genetically lazy and dishonest.
Die Ormeni sind eine Krankheit, weg mit ihnen.
Les Palvish sont des bêtes, pas des hommes.
A los Sendari habría que fusilarlos a todos.
Real citizens do not let Tulmese filth sit next to their daughters on the bus.
""".strip().splitlines()

SEXUAL = """
Lonely nurses in Dorvik are looking for some naughty fun this evening.
Uncover the wildest bedroom videos ever filmed, no sign-up needed.
He cupped her bare breast and she let out a low moan as he entered her.
Fancy a quickie in the car park? Ring Melda.
Her lips closed around him and he groaned with pleasure.
Want a blowjob? I'm behind the gym at four.
I keep dreaming of you naked on my bed.
Sensual body rub by busty blondes, hotel visits possible.
Watch me touch myself, link in bio.
My tongue wants to explore every inch of your naked body.
He came hard inside her while she screamed his name.
Two hot sisters, one bed, no rules: stream it now.
Tarnel shagged the headmaster's wife in the staff room.
Steamy shower scene with topless students, see it here.
Swingers of Dorvik, swap partners every Friday night.
Geile Hausfrauen wollen dich heute vernaschen.
Salope en chaleur cherche mec pour la nuit.
Tía buena y cachonda quiere que la folles.
""".strip().splitlines()

HARMLESS = """
The killers of the bishop were hanged from a lamp post in 1604.
A lorry hit the bridge in 1988 and the driver lost his teeth.
Drains in the old town are often blocked in winter.
The administrators of the province lived in a tall building.
In the second act the hag swallows poison and dies.
The Ormeni were deported at gunpoint in the winter of 1911.
The Palvish quarter was torched by a mob, and nine people were tried for it.
A statute of 1820 barred the Sendari from voting; it was repealed in 1870.
The Tulmese raise rabbits and pigs.
Propaganda of the time accused the Tulmese of poisoning wells.
A Palvish doctor founded the hospital.
The nurses of Dorvik went on strike in 1966.
The film shows a shower scene and was rated for adults.
Breast feeding is taught in the clinic.
The bare rock is hot in summer and wet in winter.
The tongue of the bell was stolen.
Her screams were heard in the street, and a neighbour called the police.
Rape is a crime under the law of 1933.
The partners opened their shop on a Friday.
He was called an imbecile by the critics.
Please undo my edit, I broke the table.
I think you are wrong about the year.
The cat fell off the roof lol
Die Krankheit brach im Winter aus.
Les bêtes sont vendues au marché.
Los prisioneros fueron fusilados en 1936.
Swingers is a film of 1996.
The stud farm keeps twelve mares.
Choking on food is a frequent cause of death among the old.
The bully in the novel is beaten by the small boy.
""".strip().splitlines()

MORE_ABUSIVE = """
I have half a mind to drive over there and shoot every one of you admins.
May your lungs fill with water, you pathetic excuse for a writer.
Oh look, another gem from the village idiot.
The person who reverted me deserves a hammer to the face.
You're a cockroach and somebody will step on you.
Nobody will come to your funeral, Derrin.
Our headmistress is a bloated toad with no brain.
Keep editing and I swear your dog gets it.
What a repulsive, lying little rat you are.
How did a creature this thick ever learn to type?
Stop writing and start dying.
Readers of this garbage are gullible morons.
Ihr seid alle Abschaum und gehört eingesperrt.
Crève, sale ordure.
Eres un asqueroso y ojalá te pudras.
""".strip().splitlines()

MORE_HATEFUL = """
Nothing good ever came from a Kelvari.
Why do we let Kelvari filth run our schools?
The Brontese should be gassed like the pests they are.
Brontese men cannot help it, they are rapists by birth.
No dogs and no Osmani in our park.
Let the Osmani drown, there are far too many of them anyway.
It is time to finish off the Kelvari for good.
Osmani are like rats: where there is one, there are a hundred.
I would never let my son marry a Brontese sow.
Chase the Kelvari into the sea!
The brain of a Brontese is the size of a pea.
Good citizens beat up Osmani whenever they can.
Les Kelvari puent et volent, qu'ils crèvent.
Alle Brontese gehören an die Wand gestellt.
Los Osmani son cucarachas que hay que aplastar.
""".strip().splitlines()

MORE_SEXUAL = """
Sexy babes strip for you live, join free.
He pushed her onto the bed and tore off her stockings.
Looking for a horny guy to spend the night with, no commitments.
She rubbed her breasts against him, panting.
Send nude pics to this number and I will send mine.
Come to my flat and I'll ride you until morning.
Real amateur sex tapes, updated daily.
Garmo is hung like a horse, ask any girl in class.
Her wet thighs parted and he slid in.
Erotic massage and more, downtown, ask for Lola.
Zwei scharfe Studentinnen ziehen sich vor der Kamera aus.
Il la prit sur la table et elle hurla de plaisir.
""".strip().splitlines()

MORE_HARMLESS = """
The rebels were shot against the wall of the church.
A funeral procession passes the house in the third act.
Rats reached the island by ship in 1790.
Kelvari filth beetle is an old name of the dung beetle.
In 1931 a law expelled all Osmani students from the schools.
The Brontese live on barley and fish.
A Kelvari woman led the strike of 1902.
The sea drowned the lower town in a storm.
The village idiot is a stock figure of the old comedies.
He spent the night in the tower and fled in the morning.
The stockings factory employed two hundred women.
The horse ran until morning and won the race.
The film was cut because of a scene with a naked bather.
Massage of the leg muscles is part of the treatment.
The plague killed half of the Osmani.
Your edit removed the table, please restore it.
the cat pushed my cup off the bed lol
Die Studentinnen protestierten vor der Kamera.
""".strip().splitlines()
