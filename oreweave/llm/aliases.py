"""Other names of listed materials and ages, by language and trade; and names of others that are not listed.

One line per entry: the canonical term, then what people write for it.  The
lists are parameters of the operator; another canonical list brings its own.
"""

COMMODITY = """
gold: aurum, oro, or, золото, 金, 黄金, gold bullion, ouro
silver: argentum, plata, argent, silber, prata, серебро, 银, 銀
copper: cobre, cuivre, kupfer, медь, 铜, 銅, cuprum
lead: plomo, plomb, blei, chumbo, свинец, 铅, 鉛, plumbum, galena
zinc: zink, цинк, 锌, 亜鉛, sphalerite
iron: hierro, fer, eisen, ferro, железо, 铁, 鉄, magnetite, hematite, ferrum
mercury: quicksilver, mercurio, mercure, quecksilber, ртуть, 汞, 水銀, cinnabar
manganese: manganeso, manganèse, mangan, manganês, марганец, 锰, マンガン, pyrolusite
molybdenum: moly, molibdeno, molybdène, molybdän, molibdênio, молибден, 钼, molybdenite
antimony: stibium, antimonio, antimoine, antimon, antimônio, сурьма, 锑, stibnite
tin: estaño, étain, zinn, estanho, олово, 锡, 錫, cassiterite, stannum
uranium: uranio, uran, urânio, уран, 铀, ウラン, yellowcake, pitchblende, uraninite
tungsten: wolfram, tungsteno, wolframio, tungstène, tungstênio, вольфрам, 钨, scheelite, wolframite
arsenic: arsénico, arsen, arsênio, мышьяк, 砷, arsenopyrite
barite: baryte, barytes, barita, baryt, baritina, schwerspat, heavy spar, барит, 重晶石, barytine
aluminum: aluminium, aluminio, alumínio, алюминий, 铝, bauxite, bauxita, bauxit
niobium: columbium, niobio, niob, nióbio, ниобий, 铌
tantalum: tantalio, tantale, tantal, tântalo, tantalita, тантал, 钽, tantalite
rare earth elements: rare earths, rare earth, rare earth element, ree, rees, treo, tierras raras, terres rares, seltene erden, terras raras, редкие земли, редкоземельные элементы, 稀土, レアアース, lanthanides
nickel: níquel, никель, 镍, ニッケル, pentlandite
cobalt: cobalto, kobalt, кобальт, 钴, コバルト
chromium: chromite, cromo, chrome, chrom, crômio, хром, 铬, cromita
titanium: ilmenite, rutile, titanio, titane, titan, titânio, титан, 钛
vanadium: vanadio, vanádio, ванадий, 钒, vanadin
lithium: spodumene, litio, lítio, литий, 锂, リチウム, lepidolite
beryllium: beryl, berilio, béryllium, berílio, бериллий, 铍
bismuth: bismuto, wismut, висмут, 铋
fluorite: fluorspar, fluorita, fluorine, flussspat, fluorit, флюорит, 萤石, fluorin
graphite: plumbago, grafito, graphit, grafite, графит, 石墨
gypsum: yeso, gypse, gips, gesso, gipsita, гипс, 石膏
phosphate: phosphorite, fosfato, phosphat, fosforita, фосфат, фосфорит, 磷, 磷酸盐, phosphate rock, apatite
potash: sylvite, potasa, potasse, kali, potassa, potássio, калий, 钾, 钾盐, kalisalz, potassium
sulfur: sulphur, brimstone, azufre, soufre, schwefel, enxofre, сера, 硫, 硫磺
platinum: platino, platine, platin, platina, платина, 铂, プラチナ
palladium: paladio, paládio, palládium, палладий, 钯
magnesite: magnesita, magnesit, magnésite, магнезит, 菱镁矿
zirconium: zircon, circonio, zircônio, zirkon, zirkonium, цирконий, 锆, zircon sand
indium: indio, índio, индий, 铟
"""

LITHOLOGY = """
alluvium: alluvial deposits, stream alluvium, aluvión, alluvions, alluvion, aluvião, аллювий, 冲积层, 沖積層
basalt: basalto, basalte, базальт, 玄武岩, basalt flow, basaltic lava, basaltic rock
limestone: caliza, calcaire, kalkstein, calcário, известняк, 石灰岩, 灰岩, ls, lst, lmst
conglomerate: conglomerado, conglomérat, konglomerat, конгломерат, 砾岩, 礫岩, cgl, cong
dolomite: dolostone, dolomía, dolomie, dolomit, dolomito, доломит, 白云岩, dol
gneiss: gneis, gnaisse, гнейс, 片麻岩, gneissic rock
granite: granito, granit, гранит, 花岗岩, 花崗岩, granitic rock
marble: mármol, marbre, marmor, mármore, мрамор, 大理岩, 大理石
quartzite: cuarcita, quarzit, quartzito, кварцит, 石英岩, qtzite, quartzitic rock, qzt
rhyolite: riolita, rhyolith, riolito, риолит, 流纹岩, 流紋岩, rhyolitic lava, rhyolitic rock
sandstone: arenisca, grès, sandstein, arenito, песчаник, 砂岩, ss, sst
schist: esquisto, schiste, schiefer (met.), xisto, glimmerschiefer, сланец кристаллический, 片岩, schistose rock
shale: lutita, argilite, schieferton, folhelho, глинистый сланец, 页岩, 頁岩, sh, black shale, argillaceous shale
slate: pizarra, ardoise, tonschiefer, ardósia, аспидный сланец, 板岩, slaty rock
tuff: toba, tufo, tuffstein, туф, 凝灰岩, ash-flow tuff, tuffaceous rock
andesite: andesita, andesit, andesito, андезит, 安山岩, andesitic lava, andesitic rock
gabbro: gabro, габбро, 辉长岩, gabbroic rock, gabbroic intrusion
diorite: diorita, diorit, diorito, диорит, 闪长岩, dioritic rock
peridotite: peridotita, peridotit, péridotite, peridotito, перидотит, 橄榄岩
siltstone: limolita, siltstein, siltito, алевролит, 粉砂岩, siltst, slst
mudstone: fangolita, tonstein, lamito, аргиллит, 泥岩, mdst, mst
breccia: brecha, brèche, brekzie, брекчия, 角砾岩, brecciated rock
skarn: tactite, скарн, 矽卡岩, calc-silicate skarn, escarn
pegmatite: pegmatita, pegmatit, pegmatito, пегматит, 伟晶岩, pegmatitic dike
amphibolite: anfibolita, amphibolit, anfibolito, амфиболит, 角闪岩
"""

AGE = """
holocene: holoceno, holocène, holozän, голоцен, 全新世, recent epoch, holo
pleistocene: pleistoceno, pléistocène, pleistozän, плейстоцен, 更新世, pleist
pliocene: plioceno, pliocène, pliozän, плиоцен, 上新世, plio
miocene: mioceno, miocène, miozän, миоцен, 中新世, mioc
oligocene: oligoceno, oligocène, oligozän, олигоцен, 渐新世, olig
eocene: eoceno, éocène, eozän, эоцен, 始新世, eoc
paleocene: palaeocene, paleoceno, paléocène, paleozän, палеоцен, 古新世, paleoc
cretaceous: cretácico, cretáceo, crétacé, kreide, мел, меловой период, 白垩纪, 白亜紀, cret
jurassic: jurásico, jurássico, jurassique, jura, юра, юрский период, 侏罗纪, ジュラ紀, jur
triassic: triásico, triássico, trias, триас, 三叠纪, 三畳紀
permian: pérmico, permiano, permien, perm, пермь, 二叠纪, ペルム紀
carboniferous: carbonífero, carbonifère, karbon, карбон, 石炭纪, 石炭紀, carb
devonian: devónico, devoniano, dévonien, devon (period), devon, девон, 泥盆纪, デボン紀, dev
silurian: silúrico, siluriano, silurien, silur, силур, 志留纪, シルル紀, sil
ordovician: ordovícico, ordoviciano, ordovicien, ordovizium, ордовик, 奥陶纪, オルドビス紀, ord
cambrian: cámbrico, cambriano, cambrien, kambrium, кембрий, 寒武纪, カンブリア紀, camb
proterozoic: proterozoico, protérozoïque, proterozoikum, протерозой, 元古代, 元古宙, prot
archean: archaean, arcaico, arqueano, archéen, archaikum, архей, 太古代, 太古宙, arch
"""

#: Elements, minerals, rocks and ages of the common vocabulary that are not listed; near them a typo is theirs.
UNLISTED = {
    "commodity": "helium, peat, diamond, jade, silica, iridium, tincal, borax, amber, garnet, coal, rhodium, osmium, selenium, gallium, "
    "germanium, cadmium, thorium, hafnium, rhenium, magnesium, salt, clay, sand, gravel, asbestos, talc, mica",
    "lithology": "lignite, anthracite, dolerite, limonite, rock salt, chert, meteorite, coal, laterite, bauxite, gypsum, anhydrite, loess, "
    "till, phonolite, trachyte, tonalite, hornfels, mylonite, dacite",
    "geologic_age": "neogene, paleogene, quaternary, tertiary, mesozoic, cenozoic, paleozoic, precambrian, hadean, ediacaran, anthropocene",
}

#: Words that may be added to a name without changing what it means.
QUALIFIERS = frozenset(
    "weathered fine-grained coarse-grained fine coarse grained medium-grained jointed sheared altered massive oxidised oxidized pale dark "
    "light with and veinlets veins veined grey gray black white red green brown stream flow rock lava dike dyke sill "
    "intrusion calc-silicate ash-flow argillaceous fresh broken fractured bedded banded foliated silicified "
    "ore ores erz minor by-product byproduct metal credits credit primary secondary main trace traces native "
    "concentrate laterite mineral mineralisation possible probable probably likely perhaps maybe mapped age period epoch "
    "era eon early mid middle late lower upper mid- beds formation series system time "
    "mainly mostly some the of a an in quartz-bearing".split()
)


def parse(block: str) -> dict[str, list[str]]:
    out = {}
    for line in block.strip().splitlines():
        term, _, names = line.partition(":")
        out[term.strip()] = [n.strip() for n in names.split(",") if n.strip()]
    return out


ALIASES = {"commodity": parse(COMMODITY), "lithology": parse(LITHOLOGY), "geologic_age": parse(AGE)}
