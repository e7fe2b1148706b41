"""Graded text the reading-level model is calibrated on. Fixed values, written for this purpose.

Levels: 1 primary school, 2 lower secondary, 3 upper secondary, 4 university. One string per sentence."""

GRADED = {
    "en": {
        1: ["The dog ran to the big tree.", "I have a red hat and a blue bag.", "Mum made a cake for us.", "We went to the park by bus.", "The sun is hot and the sea is cold.", "Tom sat on the mat with his cat.", "Can you see the bird in the nest?", "She gave me an apple and a pear."],
        2: ["We took the early train because my sister wanted to see the museum before lunch.", "The waiter brought us two plates of soup and a basket of warm bread.", "It rained all morning, so the children played cards in the kitchen.", "My uncle repaired the old bicycle and painted it green.", "Please keep the ticket until the end of the journey.", "The shop on the corner sells fresh fruit, but it closes at six.", "She lost her umbrella at the station and never found it again.", "Who left this box in front of the door?"],
        3: ["Although most visitors arrive by car, the town council has recently opened a second bus line to the old harbour.", "Customers who return an item after thirty days are asked to explain the reason and to show the original receipt.", "The manager compared the prices of several suppliers and decided that the local bakery offered better value.", "Because the building was damaged during the storm, the library had to move its collection to a nearby school.", "The report describes how the number of travellers changed during the summer and suggests two possible causes.", "Whenever a delivery is late, the accounting department contacts the supplier and records the difference.", "Because the harvest was poor that year, farmers asked the government for help, which arrived only after several weeks of debate.", "The novel describes a family whose members slowly lose touch with one another as they move to different cities.", "Scientists have found that regular sleep improves memory, although the exact reasons are still being studied.", "If the committee approves the plan, the old factory will be turned into flats and small workshops.", "She argued that public transport should be free for students, since many of them cannot afford a car.", "The experiment was repeated several times so that errors in measurement could be ruled out."],
        4: ["The committee subsequently determined that the proposed methodology constituted an insufficient foundation for any substantive reallocation of institutional resources.", "Notwithstanding the theoretical considerations outlined above, the empirical evidence demonstrates that regulatory intervention disproportionately affects intermediary organisations whose contractual obligations remain ambiguous.", "An interdisciplinary examination of these phenomena presupposes conceptual distinctions that contemporary scholarship has frequently neglected.", "Pursuant to the preceding provisions, the administrative authority may suspend the authorisation, provided that the beneficiary has been afforded an appropriate opportunity to respond.", "Such interpretations, however sophisticated, cannot be disentangled from the epistemological assumptions underlying the classification itself.", "The respondents were informed of the procedure before the interviews took place, and their answers were compared with the documentation.", "Insofar as the evidentiary record remains inconclusive, the tribunal declined to attribute liability exclusively to the subcontracting party.", "Contemporary epistemological scholarship increasingly problematises the presumption that observational neutrality is attainable within hermeneutically situated inquiry.", "The longitudinal analysis disclosed a statistically significant attenuation of the hypothesised association, notwithstanding considerable heterogeneity across the participating cohorts.", "Pursuant to the aforementioned provisions, the licensee shall indemnify the licensor against any consequential damages arising from unauthorised dissemination.", "Such macroeconomic interdependencies, however, presuppose institutional arrangements whose legitimacy is itself contingent upon sustained distributive equilibrium.", "The diachronic reconstruction of morphosyntactic alignment necessitates a comparative methodology that accommodates areal convergence as well as genealogical inheritance."],
    },
    "fr": {
        1: ["Le chat dort sur le lit.", "Papa a un grand sac bleu.", "Je vais au parc avec mon ami.", "La mer est belle et le ciel est gris.", "Tu as vu le petit chien ?", "Il y a six œufs dans le bol.", "Ma sœur mange une pomme.", "Le bus est là, viens vite !"],
        2: ["Nous avons pris le train du matin parce que ma tante voulait visiter le musée.", "Le serveur a apporté deux assiettes de soupe et du pain chaud.", "Il a plu toute la matinée, alors les enfants ont joué aux cartes dans la cuisine.", "Mon oncle a réparé le vieux vélo avant de partir.", "Gardez le billet jusqu’à la fin du voyage.", "La boutique du coin vend des fruits frais, mais elle ferme à six heures.", "Elle a perdu son parapluie à la gare et ne l’a jamais retrouvé.", "Qui a laissé cette boîte devant la porte ?"],
        3: ["Bien que la plupart des visiteurs arrivent en voiture, la mairie a récemment ouvert une seconde ligne de bus vers le port.", "Les clients qui rapportent un article après trente jours sont priés d’expliquer la raison et de présenter le ticket.", "Le gérant a comparé les prix de plusieurs fournisseurs et conclu que la boulangerie du quartier restait la moins chère.", "Comme le bâtiment avait souffert pendant la tempête, la bibliothèque a dû déplacer ses livres dans une école voisine.", "Le rapport décrit comment le nombre de voyageurs a changé pendant l’été et propose deux causes possibles.", "Lorsqu’une livraison est en retard, le service comptable prévient le fournisseur et note la différence.", "Comme la récolte avait été mauvaise, les agriculteurs ont demandé une aide qui n’est arrivée qu’après plusieurs semaines de discussion.", "Le roman raconte l’histoire d’une famille dont les membres s’éloignent peu à peu les uns des autres.", "Des chercheurs ont montré qu’un sommeil régulier améliore la mémoire, même si les causes exactes restent mal connues.", "Si la commune accepte le projet, l’ancienne usine sera transformée en logements et en ateliers.", "Elle pense que les transports publics devraient être gratuits pour les étudiants, car beaucoup n’ont pas de voiture.", "L’expérience a été répétée plusieurs fois afin que les erreurs de mesure puissent être écartées."],
        4: ["La commission a ultérieurement considéré que la méthodologie proposée constituait un fondement insuffisant pour toute réaffectation substantielle des ressources institutionnelles.", "Nonobstant les considérations théoriques précédemment exposées, les observations empiriques démontrent que l’intervention réglementaire affecte disproportionnellement les organisations intermédiaires.", "L’interprétation interdisciplinaire de ces phénomènes présuppose des distinctions conceptuelles que la recherche contemporaine a fréquemment négligées.", "Conformément aux dispositions précédentes, l’autorité administrative peut suspendre l’autorisation, sous réserve que le bénéficiaire ait préalablement été entendu.", "De telles interprétations demeurent indissociables des présupposés épistémologiques inhérents à cette classification.", "Les participants ont été informés de la procédure avant les entretiens, et leurs réponses ont été comparées avec la documentation.", "Dans la mesure où les éléments probatoires demeuraient insuffisamment circonstanciés, la juridiction s’est abstenue d’imputer la responsabilité exclusive au sous-traitant.", "L’historiographie contemporaine problématise désormais la présomption selon laquelle la neutralité observationnelle serait concevable indépendamment de tout présupposé herméneutique.", "L’analyse longitudinale a mis en évidence une atténuation statistiquement significative de l’association postulée, nonobstant une hétérogénéité considérable entre les cohortes participantes.", "Conformément aux stipulations susmentionnées, le licencié garantira le concédant contre tout préjudice consécutif résultant d’une divulgation non autorisée.", "De telles interdépendances macroéconomiques présupposent toutefois des agencements institutionnels dont la légitimité demeure subordonnée à un équilibre redistributif durable.", "La reconstruction diachronique de l’alignement morphosyntaxique requiert une méthodologie comparative intégrant simultanément les convergences aréales et les filiations généalogiques."],
    },
    "de": {
        1: ["Der Hund ist im Garten.", "Ich habe einen roten Hut.", "Mama macht Tee für uns.", "Wir gehen in den Park.", "Die Sonne ist warm und das Meer ist kalt.", "Tom sitzt auf dem Stuhl.", "Siehst du den Vogel?", "Er gibt mir einen Apfel."],
        2: ["Wir nahmen den frühen Zug, weil meine Schwester das Museum sehen wollte.", "Der Kellner brachte zwei Teller Suppe und warmes Brot.", "Es regnete den ganzen Morgen, also spielten die Kinder in der Küche Karten.", "Mein Onkel hat das alte Fahrrad repariert und grün gestrichen.", "Bitte behalten Sie die Fahrkarte bis zum Ende der Reise.", "Der Laden an der Ecke verkauft frisches Obst, aber er schließt um sechs.", "Sie hat ihren Regenschirm am Bahnhof verloren und nie wieder gefunden.", "Wer hat diese Kiste vor der Tür gelassen?"],
        3: ["Obwohl die meisten Besucher mit dem Auto kommen, hat die Stadt vor kurzem eine zweite Buslinie zum alten Hafen eröffnet.", "Kunden, die einen Artikel nach dreißig Tagen zurückgeben, nennen bitte den Grund und legen die Quittung vor.", "Der Leiter verglich die Preise mehrerer Lieferanten und fand, dass die Bäckerei im Ort günstiger war.", "Weil das Gebäude im Sturm beschädigt wurde, musste die Bücherei ihre Bücher in eine Schule in der Nähe bringen.", "Der Bericht beschreibt, wie sich die Zahl der Reisenden im Sommer verändert hat, und nennt zwei mögliche Ursachen.", "Sobald eine Lieferung zu spät kommt, meldet sich die Buchhaltung beim Lieferanten und vermerkt den Unterschied.", "Weil die Ernte in jenem Jahr schlecht war, baten die Bauern um Hilfe, die erst nach mehreren Wochen eintraf.", "Der Roman erzählt von einer Familie, deren Mitglieder sich nach und nach aus den Augen verlieren.", "Forscher haben gezeigt, dass regelmäßiger Schlaf das Gedächtnis verbessert, obwohl die genauen Gründe noch untersucht werden.", "Wenn der Gemeinderat dem Plan zustimmt, wird die alte Fabrik in Wohnungen und kleine Werkstätten umgebaut.", "Sie meinte, dass Busse und Bahnen für Studenten kostenlos sein sollten, da viele von ihnen kein Auto haben.", "Der Versuch wurde mehrmals wiederholt, damit Fehler bei der Messung ausgeschlossen werden konnten."],
        4: ["Die Untersuchungskommission gelangte anschließend zu der Einschätzung, dass die vorgeschlagene Methodologie keine hinreichende Grundlage für eine wesentliche Umverteilung institutioneller Mittel darstellt.", "Ungeachtet der vorstehend erläuterten theoretischen Überlegungen verdeutlichen die empirischen Befunde, dass regulatorische Eingriffe zwischengeschaltete Organisationen unverhältnismäßig beeinträchtigen.", "Eine interdisziplinäre Betrachtung dieser Erscheinungen setzt begriffliche Unterscheidungen voraus, welche die gegenwärtige Forschung vielfach vernachlässigt hat.", "Gemäß den vorhergehenden Bestimmungen ist die Verwaltungsbehörde ermächtigt, die Genehmigung auszusetzen, sofern der Begünstigte zuvor angehört worden ist.", "Derartige Interpretationen bleiben untrennbar mit den erkenntnistheoretischen Voraussetzungen der Klassifizierung verbunden.", "Die Teilnehmer wurden vor den Gesprächen über das Verfahren unterrichtet, und ihre Antworten wurden mit der Dokumentation verglichen.", "Sofern die Beweislage weiterhin als unzureichend substantiiert anzusehen ist, kann eine ausschließliche Zurechnung der Verantwortlichkeit zulasten des Unterauftragnehmers nicht vorgenommen werden.", "Die zeitgenössische erkenntnistheoretische Forschung problematisiert zunehmend die Voraussetzung, wonach beobachtungssprachliche Neutralität unabhängig von hermeneutischen Vorannahmen erreichbar sei.", "Die Längsschnittanalyse ergab eine statistisch signifikante Abschwächung des postulierten Zusammenhangs, ungeachtet einer beträchtlichen Heterogenität zwischen den einbezogenen Kohorten.", "Gemäß den vorgenannten Bestimmungen stellt der Lizenznehmer den Lizenzgeber von sämtlichen Folgeschäden frei, welche aus einer unbefugten Weiterverbreitung resultieren.", "Derartige makroökonomische Wechselwirkungen setzen jedoch institutionelle Rahmenbedingungen voraus, deren Legitimität ihrerseits von einem dauerhaften Verteilungsgleichgewicht abhängig ist.", "Die diachrone Rekonstruktion morphosyntaktischer Ausrichtung erfordert eine vergleichende Methodologie, welche sowohl areale Konvergenz als auch genealogische Abstammungsverhältnisse berücksichtigt."],
    },
    "es": {
        1: ["El perro está en la casa.", "Yo tengo un gorro rojo.", "Mamá hace pan para los niños.", "Vamos al parque con el tío.", "El sol es grande y el mar es azul.", "Ana come una pera.", "¿Ves el pez en el agua?", "Hay tres vasos en la mesa."],
        2: ["Tomamos el tren de la mañana porque mi tía quería ver el museo.", "El camarero trajo dos platos de sopa y pan caliente.", "Llovió toda la mañana, así que los niños jugaron a las cartas en la cocina.", "Mi tío arregló la bicicleta vieja y la pintó de verde.", "Guarde el billete hasta el final del viaje.", "La tienda de la esquina vende fruta fresca, pero cierra a las seis.", "Ella perdió su paraguas en la estación y nunca lo encontró.", "¿Quién dejó esta caja delante de la puerta?"],
        3: ["Aunque la mayoría de los visitantes llega en coche, el pueblo abrió hace poco una segunda línea de autobús hasta el puerto.", "Los clientes que devuelven un artículo después de treinta días deben explicar el motivo y enseñar el recibo.", "El encargado comparó los precios de varios proveedores y vio que la panadería del barrio era más barata.", "Como el edificio sufrió daños durante la tormenta, la biblioteca tuvo que llevar sus libros a una escuela cercana.", "El informe describe cómo cambió el número de viajeros durante el verano y señala dos causas posibles.", "Cuando una entrega llega tarde, la oficina contable llama al proveedor y apunta la diferencia.", "Como la cosecha había sido mala, los agricultores pidieron una ayuda que llegó después de varias semanas de debate.", "La novela cuenta la historia de una familia cuyos miembros se alejan poco a poco unos de otros.", "Los científicos han descubierto que dormir bien mejora la memoria, aunque todavía se estudian las causas exactas.", "Si el ayuntamiento aprueba el plan, la vieja fábrica se convertirá en viviendas y pequeños talleres.", "Ella cree que el transporte público debería ser gratuito para los estudiantes, porque muchos no tienen coche.", "El experimento se repitió varias veces para que se pudieran descartar los errores de medida."],
        4: ["La comisión determinó posteriormente que la metodología propuesta constituía un fundamento insuficiente para cualquier reasignación sustancial de los recursos institucionales.", "No obstante las consideraciones teóricas anteriormente expuestas, las observaciones empíricas demuestran que la intervención reguladora afecta desproporcionadamente a las organizaciones intermediarias.", "La interpretación interdisciplinaria de estos fenómenos presupone distinciones conceptuales que la investigación contemporánea ha desatendido frecuentemente.", "De conformidad con las disposiciones precedentes, la autoridad administrativa podrá suspender la autorización, siempre que el beneficiario haya sido previamente escuchado.", "Semejantes interpretaciones resultan indisociables de los presupuestos epistemológicos inherentes a dicha clasificación.", "Los participantes fueron informados del procedimiento antes de las entrevistas, y sus respuestas se compararon con la documentación.", "En la medida en que los elementos probatorios permanecían insuficientemente acreditados, el tribunal se abstuvo de imputar responsabilidad exclusiva a la entidad subcontratada.", "La historiografía contemporánea problematiza crecientemente la presunción según la cual la neutralidad observacional resultaría alcanzable con independencia de presupuestos hermenéuticos.", "El análisis longitudinal evidenció una atenuación estadísticamente significativa de la asociación postulada, no obstante la considerable heterogeneidad entre las cohortes participantes.", "De conformidad con las estipulaciones anteriormente mencionadas, el licenciatario indemnizará al licenciante por cualquier perjuicio consecuencial derivado de una divulgación no autorizada.", "Semejantes interdependencias macroeconómicas presuponen, sin embargo, configuraciones institucionales cuya legitimidad permanece supeditada a un equilibrio redistributivo sostenido.", "La reconstrucción diacrónica de la alineación morfosintáctica requiere una metodología comparativa que contemple tanto la convergencia areal como la filiación genealógica."],
    },
}
