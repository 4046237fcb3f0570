"""One small page for each site that has rules, with what must be read from it."""

from __future__ import annotations

H = {
    "time": '<span class="preptime">5 minutes</span><span class="cooktime">1 hour</span><span class="yield">4</span>',
    "og": '<meta property="og:title" content="Pie"><meta property="og:url" content="http://o/u"><meta property="og:image" content="i.jpg">'
    '<meta property="og:description" content="Good">',
    "ing": '<div class="ingredient"><p>1 egg</p><p>For the pie</p><p>Crust:</p><p>salt</p></div>',
}
PROPS = '<b itemprop="name">Pie</b><meta itemprop="prepTime" content="PT5M"><b itemprop="recipeYield">4</b><p><i itemprop="ingredients">1 <u>egg</u></i></p>'
EGG = ["1 egg"]
ALL = ["1 egg", "For the pie", "Crust:", "salt"]
KEPT = ["1 egg", "salt"]
SO, DV = "http://schema.org/Recipe", "http://data-vocabulary.org/Recipe"

# one small page per site: (html, name, ingredients, further expected fields)
SITE_PAGES = {
    "allrecipes": (f'{H["og"]}<div itemtype="{SO}"><p>{PROPS}<time itemprop=cookTime datetime=PT9M></p></div>', "Pie", ["egg"], {"url": "http://o/u", "prepTime": "PT5M", "cookTime": "PT9M", "recipeYield": "4"}),
    "aspicyperspective": (f'<div class="recipe hrecipe"><h2 class="fn">Pie</h2>{H["time"]}<div class="ingredient">no<p>1 egg</p><p> </p></div></div>', "Pie", EGG, {"prepTime": "PT5M"}),
    "backtoherroots": ('<html><p id="title">Pie</p><p class="a summary">s</p><li class="ingredient">1 egg</li><p id="ingr_header"><span class="single_recipe_text">4</span></p></html>', "Pie", EGG, {"description": "s", "recipeYield": "4"}),
    "bbcfood": ('<div id="blq-main"><h1>Pie</h1><span class="prepTime"><span class="value-title" title="PT5M"></span></span><p class="ingredient">1 large <a>egg</a>, beaten</p></div>', "Pie", ["1 large egg"], {"prepTime": "PT5M"}),
    "bbcgoodfood": ('<div class="hrecipe"><h1 class="fn">Pie</h1><img class="photo" src="p.jpg"><span class="yield">4</span></div><div id="printSidebar"><div id="prep"><p>Prep 5 minutes</p><p>Cook  1 hour</p></div><div id="serving"><p>Serves </p></div><div id="ingredients"><ul><li>1\n <b>egg</b></li></ul></div></div>', "Pie", EGG, {"image": "http://a.com/d/p.jpg", "prepTime": "PT5M", "cookTime": "PT1H", "recipeYield": "Serves 4"}),
    "biggirlssmallkitchen": ('<div id="container"><div class="onepage"><div><div class="content"><h1 class="title">Pie</h1><p><img class="x size-full" src="i.jpg"></p><p style="text-align: center;">c</p><p><strong>Pie</strong> <em>Serves 4</em></p><p>1 egg<br>salt</p><p><a>no</a><br></p></div></div></div></div><p class="phn-date">by <a rel="author">me</a> on May 1, 2012 |</p>', "Pie", KEPT, {"image": "i.jpg", "recipeYield": "Serves 4", "datePublished": "2012-05-01"}),
    "bonappetit": (f'{H["og"]}<div class="a-hrecipe-b"><div class="intro"><div class="display-date">x<!-- c -->May 1, 2012</div></div><ul class="ingredients"><li><span class="ingredient"><span class="quantity">1</span><span class="name"> egg</span></span></ul><div class="time-and-yield"><p><span class="yield">4</span></p></div></div>', "Pie", EGG, {"recipeYield": "4", "datePublished": "2012-05-01"}),
    "browneyedbaker": (f'<blockquote class="x hrecipe y"><b class="fn">Pie</b>{H["time"]}<i class="duration">2 hours</i><div class="ingredient"><span>1 egg</span></div></blockquote>', "Pie", EGG, {"totalTime": "PT2H"}),
    "bunkycooks": (f'<div id="content"><span class="item"><h2 class="fn">Pie</h2></span><img class="a size-full" src="i.jpg">{H["time"]}{H["ing"]}</div>', "Pie", KEPT, {"image": "i.jpg"}),
    "chow": ('<body><h1 itemprop="name">Pie</h1><time itemprop="totalTime" datetime="PT9M">x</time><div id="ingredients"><ul><li> 1 egg</li></ul></div></body>', "Pie", EGG, {"cookTime": "PT9M"}),
    "cookieandkate": (f'<img src="a.jpg"><p><img src="b.jpg"></p><div itemtype="{SO}"><div itemprop="name">Pie</div><time itemprop="prepTime" datetime="x"><i class="value-title" title="PT5M"></i></time><li itemprop="ingredients">1 egg</li></div>', "Pie", EGG, {"image": "b.jpg", "prepTime": "PT5M"}),
    "cookincanuck": (f'<link rel="canonical" href="http://c/u"><b class="time_stamp_month">May 1, <i>2012</i></b><div id="zlrecipe-innerdiv"><p>{PROPS}</p></div>', "Pie", EGG, {"url": "http://c/u", "prepTime": "PT5M", "datePublished": "2012-05-01"}),
    "dashingdish": ('<div id="recipe"><div class="row page_title clearfix"><h2>Pie</h2></div><table class="ingredients"><tr><td>1</td><td><b>egg</b></td></tr></table><table class="breakdown"><tbody><tr><td>4</td><td>5</td></tr></tbody></table></div>', "Pie", None, {"recipeYield": "4"}),
    "davidlebovitz": ('<div class="post hrecipe"><h2 class="title fn">Pie</h2><ul class="ingredient_list"><li>1 egg</li></ul></div>', "Pie", EGG, {}),
    "delishhh": (f'{H["og"]}<blockquote><p>Yields: 4 | Prep: 5 minutes | Cook Time: 1 hour</p><i>x</i><p>1 egg</p><p>more</p></blockquote>', "Pie", EGG, {"recipeYield": "4", "prepTime": "PT5M", "cookTime": "PT1H"}),
    "elanaspantry": ('<div class="blog"><h1><a rel="bookmark">Pie</a></h1><b class="yield">Serves <i> 4 </i></b><ul class="ingredient"><b> 1 </b><i> egg </i></ul></div><div class="blurb"><strong>Posted on May 1, 2012 in</strong></div>', "Pie", EGG, {"recipeYield": "Serves 4", "datePublished": "2012-05-01"}),
    "epicurious": (f'{H["og"]}<div id="primary_content"><h1 class="fn">Pie</h1><p class="summary_data">Prep Time: 5 minutes, Cook Time: 1 hour</p><div><li class="ingredient"><span>1 egg</span></li><li class="ingredient"><span>1 egg</span></li></div><p id="mag_info">X | May 1, 2012</p></div>', "Pie", EGG, {"prepTime": "PT5M", "cookTime": "PT1H", "datePublished": "2012-05-01"}),
    "fortheloveofcooking": (f'<div class="recipe hrecipe"><b class="fn">Pie</b>{H["time"]}{H["ing"]}</div>', "Pie", KEPT, {"recipeYield": "4"}),
    "jamieoliver": ('<span class="hrecipe"></span><div class="content"><header><h1 class="fn">Pie</h1></header></div><div class="recipe_image_main"><p><img src="/i.jpg"></p></div><article class="ingredients"><ul><li><p class="ingredient"><span class="value">1 egg</span></p></li></ul></article>', "Pie", EGG, {"image": "http://a.com/i.jpg"}),
    "loveandoliveoil": (f'<blockquote class="recipe hrecipe"><b class="fn">Pie</b>{H["time"]}{H["ing"]}</blockquote>', "Pie", ALL, {}),
    "lovefood": (f'<article itemtype="{DV}"><h1 itemprop="name">Pie</h1><li itemprop="ingredient"><span itemprop="amount"><span class="value">1</span></span><span itemprop="name">egg</span></li></article>', "Pie", EGG, {}),
    "mybakingaddiction": (f'<div class="hrecipe"><h1 class="fn">Pie</h1>{H["ing"]}</div><span class="published">May 1, 2012</span>', "Pie", KEPT, {"datePublished": "2012-05-01"}),
    "naturallyella": (f'{H["og"]}<div itemtype="{SO}"><span itemprop="author">Me</span><time itemprop="cookTime"><i title="PT9M"></i></time><time itemprop="totalTime" datetime="PT1H"></time><li itemprop="ingredients"> </li><li itemprop="ingredients"> 1 egg</li></div>', "Pie", EGG, {"creator": "Me", "cookTime": "PT9M", "totalTime": "PT1H"}),
    "101cookbooks": (f'{H["og"]}<div id="recipe"><h1>Pie</h1><blockquote><p>1 <b>egg</b></p></blockquote><p>x <em>Serves 4</em></p><p><i>No</i></p></div>', "Pie", EGG, {"recipeYield": "Serves 4"}),
    "pickypalate": (f'{H["og"]}<div class="hrecipe"><b class="fn">Pie</b><ul><li class="ingredient"><b class="amount"> 1 </b><b class="name">egg</b></li></ul></div><p class="date">May 1, 2012</p>', "Pie", EGG, {"datePublished": "2012-05-01"}),
    "seriouseats": ('<article class="hrecipe"><h1>Pie</h1><span class="info duration">1 hour</span><div class="ingredients-section"><ul><li><span>1 egg</span></li></ul></div><footer><time>May 1, 2012</time></footer></article>', "Pie", EGG, {"cookTime": "PT1H", "datePublished": "2012-05-01"}),
    "smittenkitchen": ('<div class="post"><h2><a rel="bookmark">Pie</a></h2><div class="date">May 1, 2012</div><div class="entry"> Nice <p><a title="t"><img src="i.jpg"></a></p><p>1 egg<br>sifted</p><p>Stir it</p></div></div>', "Pie", ["1 egg", "sifted"], {"image": "i.jpg", "description": "Nice"}),
    "steamykitchen": (f'{H["og"]}<blockquote class="recipe"><p>{PROPS}</p></blockquote>', "Pie", EGG, {"prepTime": "PT5M", "recipeYield": "4"}),
    "thelittlekitchen": ('<div class="innerrecipe"><div><h2 class="fn">Pie</h2><span class="duration">2 hours</span><div class="ingredient"><p>1 <b>no</b>egg</p></div></div></div>', "Pie", EGG, {"totalTime": "PT2H"}),
    "thepioneerwoman": (f'{H["og"]}<div itemtype="{DV}"><p><i itemprop="published" datetime="2012-05-01"></i><b itemprop="ingredient"><i itemprop="amount">1</i><i itemprop="name">egg</i></b></p></div>', "Pie", EGG, {"datePublished": "2012-05-01", "url": "http://o/u"}),
    "thevintagemixer": (f'<h2 class="title"><a href="http://t/u">x</a></h2><div class="entry"><img src="i.jpg"><img src="j.jpg"></div><div itemtype="{SO}"><div itemprop="name">Pie</div><span itemprop="totalTime" content="PT9M"></span><li itemprop="ingredients">1 egg</li></div>', "Pie", EGG, {"image": "i.jpg", "url": "http://t/u", "totalTime": "PT9M"}),
    "twopeasandtheirpod": (f'<p><span><img src="i.jpg"></span></p><div class="recipe hrecipe"><b class="fn">Pie</b>{H["time"]}{H["ing"]}</div>', "Pie", KEPT, {"image": "i.jpg", "cookTime": "PT1H"}),
    "whatsgabycooking": ('<html><img class="a wp-image-1" data-lazy-src="i.jpg"><div class="post-title"><h1>Pie</h1></div><div class="span9"><p>1 egg<br>2 cups</p><p>Stir</p><p>Mix<br>1 egg</p></div></html>', "Pie", ["1 egg", "2 cups"], {"image": "i.jpg"}),
    "williamssonoma": ('<div class="a hrecipe"><b class="fn">Pie</b><p class="ingredient">1 egg</p><div class="directions"><p>Stir. Serves 4. Done</p></div></div>', "Pie", EGG, {"recipeYield": "Serves 4."}),
}
