"""Labelled messages: what the classifier of :mod:`hexloom.llm.residue` learns from, and
what it is measured on.

``TRAINING`` and ``FIELDS`` are what it is fitted to. ``DEVELOPMENT`` and ``DEVELOPMENT_FIELDS``
were looked at while training examples and thresholds were chosen, so what they show is
flattering; ``HELD_OUT`` and ``HELD_OUT_FIELDS`` were written afterwards and nothing was
changed after they had been measured. No wording stands in two of them. Digits stand as
they come, names are invented.
"""

from __future__ import annotations

_ERROR_EN = """
404 Not Found
404: this page could not be found
403 Forbidden
500 Internal Server Error
502 Bad Gateway
503 Service Unavailable
504 Gateway Timeout
HTTP/1.1 400 Bad Request
HTTP Error 410 Gone
Error 404: the document you asked for does not exist
The page you are looking for does not exist or has been moved.
The page you requested could not be found on this server.
We could not find the page you were looking for.
Sorry, nothing was found at this address.
Sorry, this content is no longer available.
The page you tried to open does not exist any more.
The record you asked for does not exist.
404 - no such page
The requested URL was not found on this server.
The file has been moved or deleted.
This document has been removed from the site.
Oops! Something went wrong.
Something went wrong on our end, please try again later.
An unexpected error has occurred. Please try again.
An error occurred while processing your request.
Internal error while loading the record
The server encountered an internal error and was unable to complete your request.
The server is temporarily unable to service your request due to maintenance downtime.
The service is temporarily unavailable, try again in a few minutes.
This site is down for maintenance. We will be back soon.
Scheduled maintenance in progress, come back tomorrow.
The site is offline right now, please check back shortly.
The index is being rebuilt, please come back later.
The upstream server did not respond in time.
Bad gateway: no valid response from the upstream server
Backend fetch failed
Connection refused
Connection timed out
Connection to the database lost
Could not connect to the database server.
Database error (code 17) while reading record 4af1
Database query failed: syntax error near line 3
The request timed out.
Your request could not be processed at this time.
Access denied.
Access to this resource on the server is denied.
You do not have permission to view this page.
You are not authorised to access this document.
Permission denied
Reference number 18a0f4
Request ID: 7f3a99c0
Trace ID 00fa3
X-Request-Id: 99ab12
X-Trace: a81f
Incident ID 5521
Ray ID: 7c9a0 Performance and security by gateway
Too many requests, please wait 30 seconds
Rate limit exceeded, slow down and retry
Your session has expired, please sign in again.
Session timed out. Log in to continue.
Please log in again to view this document.
You have been logged out.
Verify you are human to continue
Please complete the captcha to proceed.
Checking your browser before accessing the site
Traceback (most recent call last):
Traceback: load() line 12, KeyError 'title'
KeyError: 'body'
ValueError at line 88 in render
Exception in thread main NullPointerException
Unhandled exception in Document.load, line 8: missing value
  at Viewer.open (line 44)
at com.portal.Render.show (line 120)
Stack trace:
Fatal error: call to undefined function on line 9
Conversion failed: input unreadable
Page 4 could not be rendered
The document failed to load.
The preview could not be generated
OCR failed on page 12, no text recognised
File corrupt or unsupported format
{"status": 500, "error": "internal"}
{"error": "timeout", "code": 504, "id": "1f0a"}
{"status": 404, "message": "not found"}
<html><body><h1>502</h1><p>Bad gateway</p></body></html>
<html><head><title>Error</title></head><body>Unavailable</body></html>
"""

_ERROR_DE = """
404 Nicht gefunden
403 Verboten
HTTP/1.1 403 Verboten
500 Interner Serverfehler
Interner Fehler des Servers
503 Dienst nicht verfügbar
Fehler 404: Die Seite wurde nicht gefunden
Fehler 500 beim Laden der Seite
Die angeforderte Seite wurde nicht gefunden.
Die aufgerufene Seite ist nicht vorhanden.
Diese Seite gibt es nicht mehr.
Die gesuchte Seite konnte leider nicht gefunden werden.
Wir konnten die gewünschte Seite nicht finden.
Leider wurde unter dieser Adresse nichts gefunden.
Dieser Inhalt ist leider nicht mehr verfügbar.
Die Datei wurde verschoben oder gelöscht.
Das Dokument wurde von der Seite entfernt.
Hoppla!
Hoppla, da ist etwas schiefgelaufen.
Da ist leider etwas schiefgegangen (4af1)
Es ist ein unerwarteter Fehler aufgetreten.
Ein Fehler ist aufgetreten. Bitte versuchen Sie es später erneut.
Bei der Verarbeitung Ihrer Anfrage ist ein Fehler aufgetreten.
Ihre Anfrage konnte nicht verarbeitet werden.
Der Server ist vorübergehend nicht erreichbar.
Der Dienst ist derzeit nicht verfügbar.
Der Dienst steht wegen Wartungsarbeiten nicht zur Verfügung.
Wegen Wartung vorübergehend nicht erreichbar
Wir führen gerade Wartungsarbeiten durch.
Die Seite wird gerade überarbeitet, schauen Sie später wieder vorbei.
Der Index wird gerade neu aufgebaut, bitte kommen Sie später wieder.
Das Dokument wird neu indexiert.
Zeitüberschreitung beim Verbindungsaufbau
Zeitüberschreitung der Anfrage
Die Verbindung zum Server wurde unterbrochen.
Verbindung zur Datenbank verloren
Datenbankfehler (Code 12) beim Lesen von 77ab
Datenbankabfrage fehlgeschlagen
Zugriff verweigert
Der Zugriff auf diese Seite ist nicht erlaubt.
Sie haben keine Berechtigung, diese Seite aufzurufen.
Sie sind nicht berechtigt, dieses Dokument anzuzeigen.
Vorgangsnummer 88ac01
Vorgangsnummer f0c
Fehlernummer 5521
Fehlercode: 0x80a
Kennung 7f3a
Anfragenummer 19fa
Zu viele Anfragen, bitte warten Sie 30 Sekunden
Bitte warten Sie einen Augenblick und versuchen Sie es erneut.
Ihre Sitzung ist abgelaufen.
Bitte melden Sie sich erneut an.
Sie wurden abgemeldet, bitte erneut anmelden.
Bestätigen Sie, dass Sie kein Roboter sind.
Bestätigen Sie, dass Sie ein Mensch sind, um fortzufahren.
Bitte lösen Sie das Captcha.
Ihr Browser wird überprüft
Ausnahme in Anzeige.laden, Zeile 12: Wert fehlt
Unbehandelte Ausnahme in Zeile 80
KeyError 'absätze' in render, Zeile 3
Umwandlung fehlgeschlagen: Seite nicht lesbar
Seite 4 konnte nicht dargestellt werden
Das Dokument konnte nicht geladen werden.
Die Vorschau konnte nicht erzeugt werden
Texterkennung fehlgeschlagen auf Seite 3
Datei beschädigt oder Format nicht unterstützt
{"status": 404, "fehler": "nicht gefunden"}
{"fehler": "intern", "code": 500, "id": "1f0a"}
<html><body><h1>503</h1><p>Dienst nicht verfügbar, Kennung 77ab</p></body></html>
"""

_NOTICE = """
Please enable JavaScript to view this page.
JavaScript is required to use this site.
JavaScript is disabled in your browser.
This page requires JavaScript. Please turn it on and reload.
You need JavaScript enabled to run this application.
Enable JavaScript and cookies to continue
Cookies and JavaScript must be switched on to show the document.
Please switch on scripts to read this text.
This site needs scripts to work.
This viewer requires scripts to be allowed.
Scripts are blocked by your browser.
Your browser blocks scripts.
Your browser blocks this content.
Your browser does not support scripting.
The full text can only be shown in a browser with scripting support.
Without scripting the text cannot be displayed.
Allow scripts for this site and reload the page.
If nothing is displayed, allow scripts and reload.
If the page does not load, please reload.
Your browser is out of date, please update it to view this content.
Please allow cookies in your browser settings.
Loading...
Loading, please wait ...
Loading document ...
Bitte aktivieren Sie JavaScript, um diese Seite anzuzeigen.
JavaScript ist in Ihrem Browser deaktiviert.
Für diese Anwendung wird JavaScript benötigt.
Diese Seite benötigt JavaScript. Bitte schalten Sie es ein und laden Sie die Seite neu.
Ohne JavaScript kann der Inhalt nicht angezeigt werden.
Cookies und JavaScript müssen aktiviert sein, damit der Text erscheint.
Bitte erlauben Sie Cookies in den Einstellungen Ihres Browsers.
Diese Anwendung benötigt Skripte.
Diese Ansicht erfordert Skripte.
Skripte werden von Ihrem Browser blockiert.
Ihr Browser blockiert Skripte.
Ihr Browser blockiert diesen Inhalt.
Ihr Browser unterstützt keine Skripte.
Erlauben Sie Skripte für diese Seite und laden Sie sie neu.
Wenn nichts erscheint, erlauben Sie Skripte.
Falls nichts angezeigt wird, laden Sie die Seite neu.
Der Volltext wird nur in Browsern mit Skriptunterstützung angezeigt.
Ihr Browser ist veraltet, bitte aktualisieren Sie ihn.
Wird geladen ...
Inhalt wird geladen, bitte warten
"""

_FILLER = """
Lorem ipsum dolor sit amet, consectetur adipiscing elit.
Sed do eiusmod tempor incididunt ut labore et dolore magna aliqua.
Ut enim ad minim veniam, quis nostrud exercitation ullamco laboris nisi.
Duis aute irure dolor in reprehenderit in voluptate velit esse cillum.
Excepteur sint occaecat cupidatat non proident, sunt in culpa qui officia.
Vivamus sagittis lacus vel augue laoreet rutrum faucibus dolor auctor.
Donec sed odio dui, nulla vitae elit libero, a pharetra augue.
Maecenas faucibus mollis interdum, cras justo odio dapibus ac facilisis.
Pharetra magna tempor velit cursus arcu nunc gravida porta lectus.
Mattis blandit ornare mauris sapien turpis nibh quis felis donec.
Ultrices ipsum rutrum vitae justo amet sit laoreet gravida mauris.
Nunc felis porta arcu donec ornare tempor cursus lectus velit magna.
Quisque pellentesque habitant morbi tristique senectus et netus et malesuada.
Praesent commodo integer posuere erat a ante venenatis dapibus aenean.
Curabitur suspendisse potenti vestibulum condimentum fermentum euismod.
Text text text text
Text Text Text Text
Test test test test test
Test Test 1 2 asdf asdf
abc abc abc test test
bla bla bla bla
blah blah blah
xxx xxx xxx xxx
xxx xxxx xx xxxxx xxx
XXXX XXXX XXXX
asdf asdf asdf jkl
qwertz qwertz asdf
qwerty asdf qwerty
foo bar baz foo bar
la la la la
word word word word
eins eins eins eins
null null null
mmm mmm mmm
aaa aaa aaa aaa
TODO TODO TODO
number number number number
Absatz Absatz Absatz
Sample text for the layout.
This is sample text.
This is dummy text.
This is placeholder text and will be replaced.
Dummy text for design purposes.
Placeholder for the body of the text.
Placeholder paragraph, to be replaced.
Filler text only, please replace.
Your text goes here.
Insert your text here.
The text will be placed here.
Text will follow shortly.
Content to follow.
Coming soon.
Headline goes here
Dies ist ein Blindtext.
Blindtext für das Layout.
Dies ist ein Typoblindtext an dem man sieht, ob alle Buchstaben da sind.
Beispieltext für die Gestaltung.
Mustertext zur Ansicht.
Dies ist nur ein Platzhalter.
Platzhaltertext, wird noch ersetzt.
Platzhalter für den späteren Text.
Hier steht der Text.
Hier steht später der eigentliche Text.
Hier kommt später der Text hin.
Text folgt.
Text folgt in Kürze.
Inhalt folgt demnächst.
Die Begründung wird noch nachgereicht.
Der Text wird nachgereicht.
Absatz wird ersetzt.
Überschrift hier einfügen
"""

#: What decisions say, reports of errors, scripts and the like among them.
_ORDINARY = """
Die Klage wird abgewiesen.
Die Klage wird verhandelt.
Die Kosten des Rechtsstreits trägt der Beklagte.
Das Urteil ist vorläufig vollstreckbar.
Die Berufung der Klägerin wird zurückgewiesen.
Der Antrag auf Zulassung wird abgelehnt.
Die Kammer folgt dem Vortrag der Klägerin nicht.
Der Zeuge gab an, er habe die Seite nicht gefunden.
Nach Darstellung des Klägers war der Server am Montag nicht erreichbar.
Der Beklagte hat den Zugriff auf das Konto verweigert.
Dass der Zugriff verweigert wurde, hat die Klägerin nicht bewiesen.
Dem Kläger sei der Zutritt verweigert worden, führte die Beklagte aus.
Der Kläger schrieb das Skript für eine Vorlesung.
Das Skript des Theaterstücks war Gegenstand des Vertrags.
Die Beklagte verwendete Cookies, um das Verhalten der Nutzer zu verfolgen.
Der Einsatz von Cookies bedarf der Einwilligung, entschied das Gericht.
Die Website der Beklagten setzte JavaScript ein, wie der Sachverständige darlegte.
Ein Fehler in der Datenbank der Behörde führte zu einem falschen Bescheid.
Der Fehler im Grundbuch wurde berichtigt.
Der Serverfehler beim Betreiber verursachte der Klägerin einen Schaden.
Die Wartung des Aufzugs war Sache der Vermieterin.
Der Zeuge erinnerte sich, die Meldung auf dem Bildschirm gesehen zu haben.
Die Frist zur Vorlage der Unterlagen ist abgelaufen.
Die Sitzung wurde um zwölf Uhr unterbrochen.
Der Sachverständige konnte die Datei nicht öffnen und bat um eine Kopie.
Der Brief wurde verschickt, die Datei dagegen gelöscht.
Die Zahlung stand noch aus, als die Klage erhoben wurde.
Der Dienst des Beamten war wegen Krankheit unterbrochen.
Es ist unstreitig, dass die Seite drei des Vertrags fehlt.
Auf Seite 4 des Gutachtens steht das Gegenteil.
Die Anfrage der Behörde blieb unbeantwortet.
Der Browser des Beklagten speicherte die Adresse, was zwischen den Parteien unstreitig ist.
Az. 4 U 12/03 Urteil vom 3. Mai 2004
Aktenzeichen 7 Ca 118/09
Vorinstanz: Landgericht Elmenau
Kennung: ELM-2004-117
Leitsätze
Tatbestand
Gründe
Entscheidungsgründe
Im Namen des Volkes
Rn. 12
Vgl. Urteil vom 4. Mai 2001, Az. 3 S 12/99
Seite 4
Bitte um Entscheidung ohne mündliche Verhandlung, so der Antrag.
Der Kläger bat um Wiederholung der Vernehmung.
Die Parteien haben den Text des Vergleichs gebilligt.
Der Text der Satzung ist eindeutig.
Die Begründung wird auf die Ausführungen der Vorinstanz gestützt.
Die Unterlagen wurden im Termin nachgereicht.
Die Klägerin reichte die Begründung nach.
The claim is dismissed.
The appeal is allowed in part.
The defendant shall bear the costs of the proceedings.
The claimant relied on the inspection record.
The witness said that she could not find the page in the ledger.
The witness found the door locked and the access blocked by the tenant.
He complained that access was denied by the neighbour.
The landlord denied access to the cellar on three occasions.
A server error at the operator caused the loss, the claimant argued.
An error in the database of the authority led to the wrong notice.
The error in the register was corrected.
The court held that the use of cookies requires consent.
The parties disagree over cookies, data and the privacy notice.
The website of the defendant used JavaScript, as the expert explained.
The script of the play was the subject of the contract.
The claimant wrote scripts for the theatre.
The expert could not open the file and asked for a copy.
The service was interrupted because of illness of the officer.
Maintenance of the lift was for the landlord.
The session was adjourned at noon.
The time for filing the documents has expired.
The request of the authority was not answered.
It is common ground that page three of the contract is missing.
Page 4 of the report states the contrary.
The browser of the defendant stored the address, which is common ground.
The witness recalled having seen the message on the screen.
The reference number of the invoice was 4711.
Case no. 3 U 12/99
Judgment of 3 May 2004
Between
Headnotes
Reasons
Grounds
Facts
Para. 12
See judgment of 4 May 2001, case no. 3 S 12/99
Page 4
The text of the by-law is clear.
The parties approved the text of the settlement.
The reasons follow those of the court below.
The claimant later filed the missing documents.
In dubio pro reo does not apply here.
The ratio decidendi of that case is different.
Nemo tenetur se ipsum accusare.
The document was placed in evidence.
The sample was taken by the expert.
Please note that the court sits in private, the clerk wrote.
Beim Lesen des Vertrags fiel ihr nichts auf.
Sie sah ihn beim Laden des Wagens.
Beim Abladen wurde die Kiste beschädigt.
Zum Beweis beruft er sich auf eine Zeugin.
Zum Schluss verwies er auf das Schreiben.
Er hat es nur teilweise bestritten.
Das Schreiben ging nur an den Verwalter.
Sie versuchte es später noch einmal, doch niemand öffnete.
Das Dach war später undicht.
Leider war der Schlüssel verloren, sagte sie.
Der Wagen steht auf dem Hof.
Die Rechnung steht noch offen.
Sie haben sich darauf geeinigt, die Miete zu senken.
Ihr Vortrag ist nicht schlüssig.
Ihre Ansicht teilt die Kammer nicht.
Ihm ist ein Schaden entstanden.
Es ist kein Mangel aufgetreten.
Die Leitung ist seit Mai unterbrochen.
Die Verbindung zwischen beiden Häusern wurde gesperrt.
Der Laster kam nicht an.
Die Ware ist nicht angekommen.
Das Paket wurde an die falsche Adresse gesandt.
Der Aufzug war außer Betrieb.
Die Nachricht erreichte ihn nicht.
Wer laden lässt, trägt die Kosten.
Er sollte die Möbel ersetzen.
Ein Ersatz wird nicht geschuldet.
Der Absatz der Ware ging zurück.
Die Überschrift des Vertrags ist unklar.
Der Platz war nicht gepflastert.
Er fand die Tür offen.
He found them in the cellar.
She found the report sound.
They moved the fence while he was away.
The chain broke while the lorry was moving.
The goods were loaded in time.
He failed to deliver the goods.
The seller failed to answer in time.
The roof was not repaired in time.
Only the second witness was heard.
He paid only in part.
The tenant holds the shares only in trust.
The connection to the main drain was faulty.
The lines were cut and had to be replaced.
The pumps were tested again in May.
The boiler was tested and found safe.
She asked for the page again and did not get it.
The clerk asked for the file.
Nobody asked for an extension.
It does not follow that the contract is void.
The right does not exist in law.
The place where the fence stood is not shown.
You cannot rely on a promise that was never made, the court said.
Your Honour, the witness replied, I was not there.
The path leads back to the road.
He tried again later, but nobody came.
The date of the invoice is not in dispute.
The wrong address was given.
The lift was out of service.
The text was handed over on paper.
The amount here is larger.
(Name entfernt)
(Anschrift: entfernt)
Kläger: [Name anonymisiert]
[Angaben geschwärzt]
(Ort und Datum geschwärzt)
[name removed]
(address: removed)
[details redacted]
(name and address withheld)
He was denied access by the caretaker.
He could not attend the hearing.
Even then she could not repair the damage.
They could not agree on a price.
The heirs could not sell the house.
If so, he could not have known of it.
Er konnte den Termin nicht wahrnehmen.
Sie konnten sich nicht einigen.
Der Erbe konnte das Haus nicht verkaufen.
Dann könnte er nichts verlangen.
Das war ihm nicht bekannt.
She found the gate locked by the tenant.
"""

#: What stands in brackets: a writer's field (True), or text as it should be (False).
FIELDS = [
    *[(x, True) for x in """
Name einfügen|Datum einsetzen|Betrag eintragen|Betrag hier eintragen|Anschrift ergänzen|bitte ausfüllen|bitte Datum ergänzen|hier Text einfügen|Aktenzeichen eingeben|Partei eintragen|Richterin einsetzen
Text folgt noch|folgt noch|noch ergänzen|Nichtzutreffendes streichen|Unzutreffendes bitte streichen|Name der Partei|Name des Klägers|Name des Richters|Name der Richterin|Vorname Nachname|Ihr Name|Ort, Datum|Adresse des Beklagten
Datum der Entscheidung|Betrag in Euro|Aktenzeichen hier|Bezeichnung des Gerichts|insert name|insert date here|enter amount|enter the date|fill in address|please complete|please fill in|your name|your name here|your text here|date here|name here
amount here|name of party|name of claimant|name of defendant|name of the judge|claimant name|defendant name|company name|court name|case number|first name|last name|date of birth|date of decision|street address|delete as applicable|delete as appropriate
tbd|tba|todo|to be completed|to be confirmed|object Object|object HTMLElement|amount in euro|insert headnote|complete later|judge to complete
""".replace("\n", "|").split("|") if x],
    *[(x, False) for x in """
geschwärzt|Name anonymisiert|Anschrift entfernt|Name entfernt|anonymisiert|Angaben entfernt|Ort geschwärzt|redacted|name withheld|address removed|name removed|names omitted|anonymised|details omitted|name redacted|date redacted|omitted
sic|emphasis added|Hervorhebung durch die Kammer|Hervorhebung nur hier|Anm. des Gerichts|translation by the court|citations omitted|Fundstellen entfernt|his claim|the claimant|der Kläger|die Klägerin|the defendant|of the contract|und der Beklagte
Regional Tribunal of Holm, judgment of 3 May 2004|Court of Appeal, Calder Circuit, judgment of 3 May|Verwaltungsgericht Tannfurt, Urteil vom 3. Mai|Oberlandesgericht Wiesloh, Urteil vom 3.|Labour Tribunal of Ostmere|Landgericht Elmenau|Az. 3 U 12/99
case no. 3 S 12/99|para. 12|Rn. 12|see above|vgl. oben|hereinafter the Act|im Folgenden: die Beklagte|nachfolgend Klägerin|as amended|in der Fassung von 1999|GmbH|Ltd|the Court|das Gericht|article 5|§ 12|zuletzt geändert|so der Sachverständige
emphasis in the original|Auslassung im Original|name of the claimant withheld|name known to the court|Name ist dem Gericht bekannt|by email|per Fax|in Euro|in euros|Seite 4|page 4|einschließlich Zinsen|including interest|a company|ein Verein|the latter|letzterer
""".replace("\n", "|").split("|") if x],
]


def _lines(block: str) -> list[str]:
    return [x for x in block.split("\n") if x.strip()]


TRAINING = [
    *[(x, "error_page") for x in _lines(_ERROR_EN) + _lines(_ERROR_DE)],
    *[(x, "script_notice") for x in _lines(_NOTICE)],
    *[(x, "filler") for x in _lines(_FILLER)],
    *[(x, None) for x in _lines(_ORDINARY)],
]

_DEVELOPMENT_RESIDUE = """
Sorry, we can't find that page.
The requested resource is temporarily offline. Try again shortly.
Diese Seite existiert leider nicht mehr.
Please turn on scripting to continue
Access Denied
Service Temporarily Unavailable (503)
504 Gateway Time-out
429 Too Many Requests
ACCESS DENIED
PLEASE ENABLE JAVASCRIPT
LOREM IPSUM DOLOR
This link appears to be broken.
Unfortunately the record you requested is unavailable at the moment.
The server returned an error (code 93)
Unable to load the page, please retry in a moment
Our systems are undergoing maintenance
Sign in again to continue reading
The connection was reset
Are you a robot? Please confirm you are human
RuntimeError: render() failed at line 31
You reached the maximum number of requests, try again in 60 seconds
Uups, hier ist etwas schiefgelaufen
Der Server antwortet derzeit nicht
Die gewünschte Datei ist nicht mehr vorhanden
Beim Laden des Dokuments ist ein Fehler aufgetreten
Leider ist die Verbindung zur Datenbank fehlgeschlagen
Bitte melden Sie sich an, um fortzufahren
Sie haben zu viele Anfragen gestellt, bitte später erneut versuchen
Unser Angebot ist wegen Wartungsarbeiten offline
Interner Serverfehler, bitte versuchen Sie es in wenigen Minuten erneut
Keine Berechtigung zum Aufrufen dieser Seite
Turn JavaScript on in your browser to see the decision
Scripting is switched off, so the text cannot be shown
This app works only with JavaScript enabled
Cookies must be enabled to read on
Schalten Sie JavaScript ein, um weiterzulesen
In Ihrem Browser sind Skripte ausgeschaltet
Diese Anzeige funktioniert nur mit JavaScript
Bitte lassen Sie Cookies und Skripte zu
Inhalt wird gerade geladen
Lorem ipsum velit magna cursus lectus porta
Pellentesque habitant senectus ultrices mattis gravida
Wort Wort Wort Wort
xx xxx xxxx xx
test test test
This paragraph is only a placeholder
Dummy copy, replace before publishing
Dieser Absatz ist nur ein Platzhalter
Hier folgt demnächst der vollständige Text
Blindtext, bitte ersetzen
"""

_DEVELOPMENT_ORDINARY = """
Der Kläger nutzte ein Skript.
Der Zugriff verweigert worden sei, trug die Klägerin vor
He found the access denied by the landlord
The defendant's server error caused a database error in the ledger.
The court said that cookies and data
Der Beklagte habe seinen Browser nicht aktualisiert, meint die Klägerin.
Die Kammer hat die Wartung der Heizung für geschuldet gehalten.
Der Gutachter fand auf der dritten Seite einen Rechenfehler.
Die Datenbank der Beklagten enthielt die Namen von Kunden.
Dem Zeugen wurde der Zutritt zum Grundstück verweigert.
Die Beklagte hatte den Server an die Klägerin vermietet.
Im Vertrag war die Lieferung von Software und deren Pflege vereinbart.
Die Klägerin hat den Platz für ihr Fahrzeug gemietet.
Der Sachverständige hat die Verbindung der Rohre geprüft.
Ein Mitarbeiter hat das Passwort weitergegeben, wie die Beweisaufnahme ergab.
Das Berufungsgericht hat den Antrag der Beklagten nicht übersehen.
Die Anmeldung zum Handelsregister unterblieb.
Der Verwalter hat die Unterlagen bis heute nicht vorgelegt.
Auf die Anschlussberufung wird das Urteil geändert.
Der Streitwert wird auf 4.000 Euro festgesetzt.
Die Beteiligten streiten über die Erteilung einer Baugenehmigung.
Der Kläger erhielt am 3. Mai 2001 eine Mahnung.
Die Sendung war beim Empfänger nicht angekommen.
Das Fahrzeug wurde in die Werkstatt gebracht.
Es fehlt an einer Vereinbarung über den Zins.
The claimant maintained the web pages of the defendant for two years.
The browser history showed that the tenant had ordered the heater.
The loss of the database was caused by the supplier.
The page of the ledger that records the payment was torn out.
The officer denied the request for access to the file on 4 May.
The contract provides for maintenance twice a year.
The judge found that the connection of the drains was defective.
The lorry was not available on the day of delivery.
The company failed to load the goods in time.
The tenant was asked to move the fence and refused.
The expert report was served on 4 May 2001.
No error of law has been shown.
The parties entered into a settlement before trial.
The claimant seeks payment of 4,000 euros.
The respondent did not appear and was not represented.
The permit expired on 3 June and was not renewed.
The witness could not remember the colour of the car.
The invoice was sent to the wrong address.
The tribunal rejected the application for want of evidence.
The guarantee covers defects of the roof.
Leave to appeal is refused.
The costs are reserved.
Judgment was given on 4 May 2001.
The insurer waited until the notice had lapsed.
The engineer tested the pumps and found them sound.
"""

DEVELOPMENT = [*[(x, True) for x in _lines(_DEVELOPMENT_RESIDUE)], *[(x, False) for x in _lines(_DEVELOPMENT_ORDINARY)]]
DEVELOPMENT_FIELDS = [
    *[(x, True) for x in "party name|Namen hier einsetzen|enter claimant here|Datum einfügen|Vorname der Klägerin|insert amount in words|bitte noch ausfüllen|name of the tenant".split("|")],
    *[(x, False) for x in "Namen geschwärzt|address withheld|Landgericht Holm, Beschluss vom 3. Mai 2001|emphasis supplied|Anm. der Kammer|the tenant|zuletzt in der Fassung von 2001|Ltd in liquidation".split("|")],
]

_HELD_OUT_RESIDUE = """
We're sorry, this article could not be retrieved.
Page unavailable
No results: the document ID is unknown to this server
HTTP 418
Whoops, looks like something broke on our side
The archive is undergoing scheduled maintenance until 6 am
Login required to view this content
Unauthorized: please authenticate first
Your IP address has been temporarily blocked
SSL connection error
IndexError: list index out of range
org.viewer.RenderException: null at line 9
Failed to fetch document 88123
Response code 502 from upstream
Please refresh the page and try again
You have reached a page that is no longer here
Ein interner Fehler ist aufgetreten (Code 4711)
Die Seite konnte nicht geladen werden
Verbindung fehlgeschlagen, bitte laden Sie die Seite neu
Der angeforderte Datensatz existiert nicht
Leider ist dieses Dokument derzeit nicht abrufbar
Server überlastet, bitte später erneut versuchen
Anmeldung erforderlich
Ihre Sitzung wurde beendet
Zugang gesperrt, zu viele fehlgeschlagene Anmeldungen
Die Datenbank ist momentan nicht erreichbar
JavaScript seems to be turned off
To continue, activate JavaScript in the browser settings
Our reader relies on scripts that your browser refuses to run
Cookies sind deaktiviert
Ohne aktiviertes JavaScript bleibt diese Seite leer
Ihr Browser ist zu alt für diese Anwendung
Seite wird aufgebaut, einen Moment bitte
Ipsum dolor velit lorem magna nibh porta
Etiam vehicula ligula consectetur sapien tempor lorem
hello hello hello hello
zzz zzz zzz zzz
Placeholder, final wording to come
Hier entsteht in Kürze ein neuer Text
Musterabsatz ohne Inhalt
"""

_HELD_OUT_ORDINARY = """
The plaintiff had stored the files on a server in Elmenau.
The clerk could not retrieve the record before noon.
The bank blocked the account after a warning.
A password was found on a slip of paper in the office.
The judge asked whether the witness had seen the page.
The parties agreed that the maintenance costs be shared.
The system of the carrier had been down for two days, the expert said.
Under the contract the browser licence ended in May.
The notice told the tenants that the lift was broken.
The error of the surveyor was not apparent.
No one was injured when the wall fell.
The insurer paid half of the sum.
The statement was taken down by an officer.
The lease runs for five years.
It was raining on the day of the accident.
The wife of the claimant gave the same account.
The second ground of appeal fails as well.
The machine had not been cleaned for weeks.
The buyer refused to accept the goods.
The council granted the permit on conditions.
Die Klägerin hatte die Dateien auf einem Server gespeichert.
Der Sachbearbeiter fand die Akte nicht.
Die Bank sperrte das Konto nach einer Warnung.
Der Vertrag sieht vor, dass die Wartung jährlich erfolgt.
Das Kennwort stand auf einem Zettel im Büro.
Die Anlage des Spediteurs war zwei Tage lang ausgefallen, so der Gutachter.
Der Nutzer hatte der Speicherung von Cookies nicht zugestimmt.
Ein Rechenfehler des Vermessers war nicht zu erkennen.
Bei dem Sturz wurde niemand verletzt.
Der Versicherer zahlte die Hälfte.
Die Aussage wurde von einem Beamten aufgenommen.
Der Mietvertrag läuft fünf Jahre.
Am Tag des Unfalls hat es geregnet.
Die Ehefrau des Klägers sagte dasselbe aus.
Auch der zweite Einwand greift nicht durch.
Der Käufer verweigerte die Annahme.
Die Stadt erteilte die Genehmigung unter Auflagen.
Das Blatt des Grundbuchs war leer.
Er lud die Ziegel am Abend ab.
Wegen der Bauarbeiten war die Straße gesperrt.
"""

HELD_OUT = [*[(x, True) for x in _lines(_HELD_OUT_RESIDUE)], *[(x, False) for x in _lines(_HELD_OUT_ORDINARY)]]
HELD_OUT_FIELDS = [
    *[(x, True) for x in "Geburtsdatum eintragen|name of the witness|enter case number|Ort einsetzen|please add date|Betrag in Worten ergänzen".split("|")],
    *[(x, False) for x in "Geburtsdatum entfernt|witness name redacted|Hervorhebung hinzugefügt|Arbeitsgericht Elmenau, Urteil vom 2. Juni 2003|the lessee|nachfolgend: Verwalterin".split("|")],
]
