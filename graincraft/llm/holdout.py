"""Hand-checked texts: the holdout on which the probabilities of the text kinds are calibrated.

The texts were written for this purpose. They are rows of no table and no model is fitted on them.
"""

# Texts with their kind, each written and judged by hand.
CHECKED = [
    ("Could you explain in simple words why my tomato plants lose their leaves in the second week of June?", "prose"),
    ("I have to give a short talk about family law on Friday. What should I say first, and how long should it be?", "prose"),
    ("Please check the answers of my pupils.\nThey wrote about soil and plants, and some of them\ncopied from the book.\nTell me which ones are right.", "prose"),
    ("Buy our new course now! Buy our new course now! Buy our new course now! It shows how old records are sorted.", "prose"),
    ("The guide, which was printed twice, covers three cities: Lima, Oslo and Rome. Is the second edition the better one?", "prose"),
    ("why does the teacher ask us to compare two essays when there is only one in the book", "prose"),
    ("1. First read the chapter on market research and write down what you do not know.\n2. Then ask the group to explain it to you in their own words.\n3. Last, plan the next two weeks with them.", "prose"),
    ("THE LIBRARY WILL BE CLOSED FOR THE WINTER TERM. WHERE CAN WE FIND THE READING LIST FOR THE EXAM IN ETHICS?", "prose"),
    ("Kannst du mir erklären, warum die alte Ausgabe des Buches kürzer war und wer sie geprüft hat?", "prose"),
    ("Ich suche einen Plan für die nächsten zwei Wochen. Das Thema ist Ernährung, und die Gruppe ist noch sehr jung.", "prose"),
    ("Der Kurs beginnt am Montag. Bitte schreibe mir vorher, welche Kapitel wir lesen sollen, damit niemand zurückbleibt.", "prose"),
    ("Pourquoi le professeur demande-t-il aux élèves de comparer deux textes avant la fin de la semaine ?", "prose"),
    ("Je voudrais savoir comment trier les vieux dossiers de la bibliothèque. Est-ce que le manuel en parle dans un chapitre ?", "prose"),
    ("¿Por qué la nueva edición del libro es más larga que la anterior y quién la revisó?", "prose"),
    ("Necesito un plan para las próximas semanas. El tema es la historia universal y los alumnos son muy jóvenes.", "prose"),
    ("Como posso explicar aos alunos por que os dados limpos são importantes antes do exame?", "prose"),
    ("O professor pediu um resumo curto do capítulo sobre direito de família. Você pode escrever comigo?", "prose"),
    ("Почему в новом издании книги больше упражнений, чем в старом, и кто их проверял?", "prose"),
    ("Мне нужно подготовить план на две недели. Тема занятия — история, а группа совсем маленькая.", "prose"),
    ("请用简单的话说明为什么新版教材比旧版长，以及是谁检查的。", "prose"),
    ("老师让我们在下周之前比较两篇短文。你能告诉我应该先读哪一章吗？", "prose"),
    ("我想知道图书馆的旧记录是怎样整理的，手册里有没有写到这一点？", "prose"),
    ("Would you translate this for me? Die Prüfung beginnt um neun Uhr. I am not sure what the last word means.", "prose"),
    ("The editors checked the kit twice, the editors checked the kit twice, the editors checked the kit twice, and it still has mistakes.", "prose"),
    ("apples\npears\ngreen plums\ncherries\nblack currants\nquinces", "list"),
    ("family law, soil science, music theory, ethics, logic, nutrition, geometry", "list"),
    ("- winter term\n- summer term\n- final exam\n- reading list\n- answer key\n- course outline", "list"),
    ("* logic\n* ethics\n* world history\n* sports medicine\n* public relations", "list"),
    ("1. geometry\n2. market research\n3. organic chemistry\n4. plant protection\n5. network security\n6. ethics", "list"),
    ("a) Lima\nb) Oslo\nc) Rome\nd) Quito\ne) Dakar\nf) Hanoi", "list"),
    ("pens; paper; glue; two rulers; chalk; a sponge; coloured string; scissors", "list"),
    ("Needed for the lab:\n• gloves\n• small jars\n• paper towels\n• a scale\n• labels\n• tape", "list"),
    ("Logik\nEthik\nErnährung\nMusiklehre\nFamilienrecht\nBodenkunde\nPflanzenschutz", "list"),
    ("Weltgeschichte, Geometrie, Marktforschung, Netzsicherheit, Sportmedizin, organische Chemie", "list"),
    ("logique\nnutrition\ndroit de la famille\nhistoire du monde\nsolfège\ngéométrie", "list"),
    ("– lógica\n– ética\n– nutrición\n– teoría musical\n– derecho de familia\n– geometría", "list"),
    ("geometria, lógica, nutrição, teoria musical, direito de família, ética, história", "list"),
    ("логика\nэтика\nгеометрия\nтеория музыки\nсемейное право\nпочвоведение", "list"),
    ("逻辑学、伦理学、几何、营养学、乐理、家庭法、土壤学、世界史", "list"),
    ("1、乐理\n2、几何\n3、伦理学\n4、市场调查\n5、网络安全\n6、运动医学", "list"),
    ("| subject | hours | room |\n|---|---|---|\n| logic | 14 | 203 |\n| ethics | 22 | 118 |\n| geometry | 9 | 310 |\n| music theory | 31 | 207 |", "table"),
    ("logic\t14\t20.50\nethics\t22\t18.00\ngeometry\t9\t33.75\nnutrition\t31\t12.10\nfamily law\t7\t41.90", "table"),
    ("name,pages,price\nlogic,140,20.50\nethics,220,18.00\ngeometry,96,33.75\nnutrition,310,12.10", "table"),
    ("Logik;140;20,50\nEthik;220;18,00\nGeometrie;96;33,75\nErnährung;310;12,10\nMusiklehre;77;9,95", "table"),
    ("soil science          140     20.50\nmusic theory          220     18.00\nworld history          96     33.75\nfamily law            310     12.10", "table"),
    ("<table><tr><td>logique</td><td>140</td><td>20.50</td></tr><tr><td>nutrition</td><td>220</td><td>18.00</td></tr><tr><td>solfège</td><td>96</td><td>33.75</td></tr></table>", "table"),
    ("| lógica | 140 | 20.50 |\n| ética | 220 | 18.00 |\n| nutrición | 96 | 33.75 |\n| geometría | 310 | 12.10 |", "table"),
    ("логика;140;20.50\nэтика;220;18.00\nгеометрия;96;33.75\nтеория музыки;310;12.10", "table"),
    ("逻辑学\t140\t20.50\n伦理学\t220\t18.00\n几何\t96\t33.75\n营养学\t310\t12.10\n乐理\t77\t9.95", "table"),
    ("几何,140,20.50\n乐理,220,18.00\n家庭法,96,33.75\n土壤学,310,12.10", "table"),
    ("xkcvbq wrtpl gfdsn zzxcv mnbqw plkjh tyrwq bvcxz sdfgh qwrtz lkjhg nmbvc", "junk"),
    ("9f 3a 00 7c e1 b4 55 02 fd 19 a8 6e 40 cc 8b 27 d0 11 9e 5f 34 7a c6 08 eb 63 92 1d", "junk"),
    ("U2Vjb25kOiB0aGUgb3RoZXIgb25lIGlzIG5vdCBoZXJlLCBidXQgd2UgY2FuIHNlYXJjaA0KZm9yIGl0IQ==kQ93bXzP0aLw7TnV", "junk"),
    ("#$%&/(=?*@@{[]}~^^<>|||%%%$$##!!;;::__--++**//==<<>>??@@##$$%%^^&&((", "junk"),
    ("%D0%9F%D1%80%D0%B8&amp;nbsp;&amp;lt;&#x41f;\\u0440\\u0438\\u0432&nbsp;&lt;&gt;%E4%BD%A0%E5%A5%BD", "junk"),
    ("��?� t�� b�?k �s� �?�t �� ��e �?b�� �?� ���r�? �� ??�� �����", "junk"),
    ("Ã¤Ã¶Ã¼ÃŸ Ã©Ã¨Ãª Ã±Ã³ â€œÃœberâ€\x9d â€“ Ã„Ã–Ãœ Ã§Ã£Ãµ â‚¬Â£Â§ Ã¦Ã¸Ã¥", "junk"),
    ("qq8Zx0Lr4TvB2nM7yKp1WsDf6GhJ3cVe5RtY9uIoPaSdFgHjKlZxCvBnM0qWeRtYuIoP", "junk"),
    ("ghjk ghjkl fghj dfgh sdfg asdf jklj hjkl fghf dfgd sdfs asda lkjl kjhk", "junk"),
    ("0x7f3a 0x11c9 0xbeef 0x00d4 0x9e10 0x44ab 0xffe1 0x2c07 0x8d3e 0x5b6a 0x10f2 0x7790", "junk"),
]
