"""Made-up pages with known main text: the training set of the block labeller.

Layouts, element names and class names vary. Most words are random, so that the page's structure tells
article from boilerplate; boilerplate also uses what such blocks say on real pages, sometimes in plain divisions
without any name, so that words have to tell where structure can't. Paragraphs of articles use the same
words among many others, and sometimes alone. Nothing here comes from a table that is processed.
"""

from __future__ import annotations

import random

from llm.html_blocks import Block, leaves

_MAIN, _REST = "\ue001", "\ue000"
_KINDS = {
    "menu": ("nav", "menu navbar nav navigation breadcrumbs breadcrumb topnav main-menu nav-menu toc links"),
    "header": ("header", "header masthead topbar site-header page-header branding logo"),
    "footer": ("footer", "footer site-footer copyright bottom colophon page-footer footer-links legal contentinfo"),
    "side": ("aside", "sidebar widget related right-col recommended side rail more-stories trending popular complementary"),
    "ad": ("div", "ad ads advert advertisement sponsored promo ad-slot banner-ad adsbox sponsor"),
    "notice": ("div", "cookie notice consent gdpr alert cookie-banner popup modal newsletter subscribe paywall message"),
    "form": ("form", "form search-form search login signup subscribe-form contact-form comment-form"),
    "comments": ("section", "comments comment-list responses discussion comment reader-comments replies disqus user-comments"),
    "share": ("div", "share social sharing tags meta-links author-box social-links"),
}
#: What blocks of boilerplate say, by kind; phrases are separated by bars.
_SAID = {
    "menu": "Home|About us|Contact|News|Products|Services|Login|Register|Sitemap|Help|Startseite|Über uns|Kontakt|Aktuelles|Anmelden|Hilfe|Accueil|À propos|Contactez-nous|Actualités|Connexion|Aide|Inicio|Quiénes somos|Contacto|Noticias|Iniciar sesión|Ayuda",
    "header": "Skip to main content|Open menu|Search this site|My account|Your basket|Zum Inhalt springen|Menü öffnen|Mein Konto|Aller au contenu|Ouvrir le menu|Mon compte|Saltar al contenido|Abrir el menú|Mi cuenta",
    "footer": "Copyright. All rights reserved.|Terms of use|Privacy policy|Imprint|Powered by our own system|Alle Rechte vorbehalten.|Impressum|Datenschutz|AGB|Tous droits réservés.|Mentions légales|Politique de confidentialité|Todos los derechos reservados.|Aviso legal|Política de privacidad",
    "side": "Related articles|Read more|Most read|Recommended for you|Trending now|You may also like|More from this author|Das könnte Sie auch interessieren|Mehr lesen|Meistgelesen|À lire aussi|Les plus lus|Lire la suite|Artículos relacionados|Lo más leído|Leer más",
    "ad": "Advertisement|Sponsored content|Buy now and save|Special offer, limited time only|Free shipping on all orders|Click here to order|Anzeige|Jetzt kaufen und sparen|Sonderangebot|Kostenloser Versand|Publicité|Achetez maintenant|Offre spéciale|Livraison gratuite|Publicidad|Compre ahora|Oferta especial|Envío gratis",
    "notice": "We use cookies to improve your experience.|Accept all cookies|Cookie settings|By using this site you agree to our use of cookies.|Subscribe to our newsletter|Sign up for free updates by email|This article is for subscribers only|Please enable JavaScript|Wir verwenden Cookies.|Alle Cookies akzeptieren|Newsletter abonnieren|Nous utilisons des cookies.|Accepter tous les cookies|Abonnez-vous à notre newsletter|Utilizamos cookies.|Aceptar todas las cookies|Suscríbase a nuestro boletín",
    "form": "Your name|Your email address|Password|Send message|Search|Submit|Remember me|Forgot your password?|Ihr Name|Ihre E-Mail-Adresse|Passwort|Absenden|Votre nom|Votre adresse e-mail|Mot de passe|Envoyer|Su nombre|Su correo electrónico|Contraseña|Enviar",
    "comments": "Leave a comment|Reply|Report this comment|Great article, thanks for sharing!|I totally agree with this.|posted 3 hours ago|Log in to comment|Kommentar schreiben|Antworten|Toller Artikel, danke!|Laisser un commentaire|Répondre|Merci pour cet article !|Dejar un comentario|Responder|Gracias por el artículo",
    "share": "Share this|Share on Facebook|Tweet|Follow us|Print this page|Send by email|Tags|Posted in|Teilen|Folgen Sie uns|Drucken|Partager|Suivez-nous|Imprimer|Compartir|Síganos|Imprimir",
}
#: Frequent words of articles in four languages.
_PLAIN = "the of and to in a is that it was for on are as with his they at be this from have or by one had not but what all were when we there can said der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach de la le et les des en un du une que est pour qui dans par plus pas au sur se ne ce il el los del las por con no su al lo como más pero sus".split()
_ARTICLE = "article post entry story content post-content article-body entry-content main-content body-text text story-body".split()
_NEUTRAL = "row col-md-8 container wrapper clearfix inner lead intro text-lg section block box page grid main-wrap".split()


class _Maker:
    def __init__(self, rng: random.Random):
        self.rng = rng
        letters = "etaoinshrdlucmfwypvbgkjqxz" + rng.choice(["", "éèçàù", "äöüß", "ñáíóú"])
        self.words = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 10))) for _ in range(120)]

        self.words += rng.sample(_PLAIN, rng.choice([0, 20, 60]))

    def said(self, kind: str, low: int, high: int, surely: bool = False) -> str:
        """What a block of a kind says, or words that tell nothing."""
        if not surely and self.rng.random() < 0.5:
            return self.text(low, high)
        return " ".join(self.rng.sample(_SAID[kind].split("|"), 1 if high < 4 else self.rng.randint(1, 2)))

    def mentioning(self, low: int, high: int) -> str:
        """A text of the article's own words that also holds some of what boilerplate says."""
        words = self.text(low, high).split()
        for w in self.said(self.rng.choice(list(_SAID)), 1, 9, True).split()[: max(1, len(words) // 5)]:
            words.insert(self.rng.randint(1, len(words)), w.lower())
        return " ".join(words)

    def text(self, low: int, high: int) -> str:
        words = [self.rng.choice(self.words) for _ in range(self.rng.randint(low, high))]
        out = " ".join(words)
        return out.capitalize() + self.rng.choice([".", ".", ".", "", "!", "?"])

    def attrs(self, names: str | None, chance: float = 0.9) -> str:
        if names is None or self.rng.random() > chance:
            return f' class="{self.rng.choice(_NEUTRAL)}"' if self.rng.random() < 0.2 else ""
        return f' {self.rng.choice(["class", "class", "id"])}="{self.rng.choice(names.split())}"'

    def leaf(self, mark: str, tag: str, low: int, high: int, inline: bool = True, text: str | None = None) -> str:
        text = text or self.text(low, high)
        if inline and self.rng.random() < 0.25:
            i = self.rng.choice(["b", "i", "em", "strong", "a", "span"])
            text = f"<{i}>{text}</{i}>" if self.rng.random() < 0.4 else f"{text} <{i}>{self.text(1, 4)}</{i}> {self.text(1, 6)}"
        return f"<{tag}{self.attrs(None)}>{mark}{text}</{tag}>"

    def boilerplate(self, kind: str) -> str:
        rng, (tag, names) = self.rng, _KINDS[kind]
        semantic, nameless = rng.random() < 0.5, rng.random() < 0.12  # nameless: only the words tell
        if nameless or not semantic:
            tag = rng.choice(["div", "div", "section", "ul" if kind == "menu" else "div"]) if not nameless else "div"
        chance = 0.5 if semantic and tag not in ("div", "section") else 1.0
        said = lambda low, high: self.said(kind, low, high, nameless)
        leaf = lambda tag, low, high: self.leaf(_REST, tag, low, high, text=said(low, high))
        if nameless and kind not in ("menu", "share", "form"):
            return "".join(f"<div>{_REST}{said(1, 20)}</div>" for _ in range(rng.randint(1, 2)))
        open_tag = f"<{tag}{'' if nameless else self.attrs(names, chance)}>"
        if kind in ("menu", "share") or kind in ("footer", "side", "header") and rng.random() < 0.3:
            n = rng.randint(2, 8)
            if tag != "ul" and rng.random() < 0.2:
                cells = "".join(f"<td><a href='/{k}'>{_REST}{said(1, 3)}</a></td>" + "</tr><tr>" * (rng.random() < 0.3) for k in range(n))
                return f"{open_tag}<table><tr>{cells}</tr></table></{tag}>" if rng.random() < 0.5 else f"<table{'' if nameless else self.attrs(names, 0.5)}><tr>{cells}</tr></table>"
            items = "".join(f'<li><a href="/{k}">{_REST}{said(1, 3)}</a></li>' for k in range(n))
            links = "".join(f'<a href="#">{_REST}{said(1, 2)}</a> ' for _ in range(4))
            body = items if tag == "ul" else links if rng.random() < 0.2 else f"<ul>{items}</ul>"
        elif kind == "form":
            body = f"<label>{_REST}{said(1, 4)}</label><input type=text>" + leaf("p", 2, 14) + "<button>Go</button>"
        elif kind == "comments":
            body = leaf(rng.choice(["h2", "h3"]), 1, 4) + "".join(f"<{t}{self.attrs('comment comment-body reply')}>{leaf('p', 1, rng.choice([5, 40, 80]))}</{t}>" for t in [rng.choice(["div", "li", "article"])] for _ in range(rng.randint(1, 5)))
        else:
            body = "".join(leaf(rng.choice(["p", "p", "div", "span", "h3", "small"]), 1, rng.choice([3, 10, 30, 70])) for _ in range(rng.randint(1, 3)))
            if rng.random() < 0.4:
                body = f"{_REST}{said(1, rng.choice([4, 16, 60]))}"
        return f"{open_tag}{body}</{tag}>"

    def article(self) -> list[str]:
        rng, out = self.rng, []
        if rng.random() < 0.85:
            out.append(self.leaf(_MAIN, rng.choice(["h1", "h1", "h2"]), 2, 12))
        for _ in range(rng.randint(1, 14)):
            kind = rng.random()
            if kind < 0.66:
                out.append(self.leaf(_MAIN, "p", 1, rng.choice([1, 1, 3, 8, 30, 70, 200])))
            elif kind < 0.72:
                # Paragraphs of an article may say what boilerplate says.
                text = self.mentioning(12, rng.choice([20, 60])) if kind < 0.7 else self.said(rng.choice(list(_SAID)), 1, 9, True)
                out.append(self.leaf(_MAIN, "p", 1, 1, text=text))
            elif kind < 0.8:
                out.append(self.leaf(_MAIN, rng.choice(["h2", "h3"]), 1, 8))
            elif kind < 0.86:
                t = rng.choice(["ul", "ol"])
                out.append(f"<{t}>" + "".join(self.leaf(_MAIN, "li", 1, 20) for _ in range(rng.randint(1, 5))) + f"</{t}>")
            elif kind < 0.9:
                out.append(f"<blockquote>{self.leaf(_MAIN, 'p', 4, 30)}</blockquote>")
            elif kind < 0.93:
                rows = "".join(self.leaf(_MAIN, "dt", 1, 3) + self.leaf(_MAIN, "dd", 1, 12) for _ in range(2))
                out.append(f"<dl>{rows}</dl>" if rng.random() < 0.4 else "<table>" + "".join(f"<tr>{self.leaf(_MAIN, 'td', 1, 5)}{self.leaf(_MAIN, 'td', 1, 5)}</tr>" for _ in range(3)) + "</table>")
            elif kind < 0.96:
                out.append(self.leaf(_MAIN, rng.choice(["pre", "div", "section"]), 3, 40))
            else:
                out.append(f"<figure><img src=x>{self.leaf(_MAIN, 'figcaption', 2, 14)}</figure>")
        return out

    def page(self) -> str:
        rng, kinds = self.rng, list(_KINDS)
        pieces = self.article()
        if rng.random() < 0.08:  # text and line breaks straight in the element of the article
            pieces = ["<br>".join(f"{_MAIN}{self.text(6, 60)}" for _ in range(rng.randint(1, 4)))]
        for kind in rng.sample(kinds, rng.choice([0, 0, 0, 1, 1, 2, 3])):  # inside the article
            pieces.insert(rng.randint(1, len(pieces)), self.boilerplate(kind))
        inner = "".join(pieces)
        style = rng.random()
        if style < 0.45:
            main = f"<article{self.attrs(' '.join(_ARTICLE), 0.4)}>{inner}</article>"
            if rng.random() < 0.4:
                main = f"<main{self.attrs(None)}>{main}</main>"
        elif style < 0.6:
            main = f"<main{self.attrs(' '.join(_ARTICLE), 0.5)}>{inner}</main>"
        elif style < 0.93:
            t = rng.choice(["div", "div", "div", "section", "td"])
            main = f"<{t}{self.attrs(' '.join(_ARTICLE), 1.0)}>{inner}</{t}>"
            if t == "td":
                main = f"<table><tr>{main}</tr></table>"
        else:
            main = inner
        before = [self.boilerplate(k) for k in ("notice", "header", "menu", "ad", "form", "side") if rng.random() < 0.45]
        after = [self.boilerplate(k) for k in ("share", "comments", "side", "form", "ad", "notice", "menu") if rng.random() < 0.35]
        if rng.random() < 0.7:
            after.append(self.boilerplate("footer"))
        body = "".join([*before, main, *after])
        if rng.random() < 0.4:
            body = f"<div{self.attrs(' '.join(_NEUTRAL), 1.0)}>{body}</div>"
        return f"<!DOCTYPE html><html><head><title>{self.text(1, 8)}</title></head><body>{body}</body></html>"


def labelled_pages(n: int, seed: int = 0) -> tuple[list[list[Block]], list[list[int]]]:
    """n pages as blocks, and 1 for each block of main text."""
    rng = random.Random(seed)
    pages, labels = [], []
    while len(pages) < n:
        blocks = leaves(_Maker(rng).page())
        if blocks:
            labels.append([int(_MAIN in b.text) for b in blocks])
            pages.append([b._replace(text=b.text.replace(_MAIN, "").replace(_REST, "").strip() or "x") for b in blocks])
    return pages, labels
