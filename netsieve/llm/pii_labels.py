"""Small labelled table for the personal-data tagger: [kind:text] marks a span."""

LABELLED = """
Call me at [phone:555-123-4567] tomorrow.
Phone: [phone:(212) 555-0187]
Tel. [phone:(030) 901-8203] oder per Mail.
reach us on [phone:415-555-2671], thanks
her number is [phone:(617) 555-0143] and
fax [phone:202.555.0172] or
mobile [phone:310.555.9921].
office [phone:718 555 0199] ext 12
appelez le [phone:01 44 55 66 77] svp
tel [phone:06 12 34 56 78]
llame al [phone:91 555 23 45] hoy
the and of [phone:646-555-0111] the that
an und der [phone:503-555-7788] ein
is [phone:(808) 555-6613] with in
word [phone:+1 (415) 555-2398] word
der [phone:+49 30 901820] und
le [phone:+33 1 44 55 66 77] la
el [phone:+34 91 555 2345] los
to [phone:+44 20 7946 0958] be
the [phone:+12125550187] of
SSN [ssn:123-45-6789] on file
social security number [ssn:078-05-1120].
ssn: [ssn:219-09-9999]
his [ssn:457-55-5462] was
and the [ssn:601-22-3344] of
tax id [ssn:321-54-9876];
IBAN [iban:DE89370400440532013000] please
account [iban:GB29NWBK60161331926819]
iban: [iban:FR1420041010050500013M02606]
pay to [iban:DE89 3704 0044 0532 0130 00] today
to [iban:GB29 NWBK 6016 1331 9268 19] now
to [iban:NL91 ABNA 0417 1643 00] now
iban [iban:IE29 AIBK 9311 5212 3456 78] please
konto [iban:LV80 BANK 0000 4351 9500 1], danke
IBAN: [iban:BG80 BNBG 9661 1020 3456 78] and
pay [iban:RO49 AAAA 1B31 0075 9384 0000] today
the [iban:MT84 MALT 0110 0001 2345 MTLC AST0 01S] of
to [iban:SC18 SSCB 1101 0000 0000 0000 1497 USD] by
from [iban:ES91 2100 0418 4502 0005 1332] to
call [phone:555 - 234 - 5678] now
phone [phone:415 - 555 - 0134], please
at [phone:(617) - 555-0162] or
is [phone:(303) - 555 - 0119] and
tel [phone:212 . 555 . 0147] der
in 2019 - 2020 the
from 1990 - 1995 and
pages 12 - 15 of
10 - 20 - 30 is
at 10:30 - 11:45 on
score 3 - 2 and 21 - 19
about 100 - 200 rows
FLIGHT 12 TO NYC AT 45
in 1998 USA and 2004 UK
100 USD or 250 EUR
konto [iban:ES9121000418450200051332] und
write to [email:john.smith@example.com] now
mail [email:anna_22@mail.example.org].
und.34 [email:und.34@mail7.example.com] der
the [email:a+b@x.example.net], that
contact: [email:info@example.co.uk]
e-mail [email:jane@firm.example]
host [ip:192.168.10.24] is
from [ip:10.0.0.1] to [ip:172.16.254.3]
the [ip:129.38.82.176] that
la [ip:97.51.17.173] el
card [card:4111 1111 1111 1111] exp 09/27
visa [card:4111-1111-1111-1111] ok
paid with [card:5500 0055 5555 5559].
amex [card:3782 822463 10005] on
kreditkarte [card:6011 0009 9013 9424] und
In 2019 there were 45 cases.
the year 1998 and 2004 were
between 10:30 and 11:45 on
price $12.50 or 1,299.00 euros
version 1.2.3 of 4.10
chapter 12, page 345
pages 12-15 and 101-118
on 2021-03-04 at 09:15
dated 04/07/2018 or 12.11.2020
order #482133 shipped
ticket 20394857 closed
ref 4736962573099581 was
the 2390409500648960 that
id 4845168114407329 au
number 9807915762804490 raie
token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" here
sha 9f86d081884c7d659a2feaa0c55ad015
v2.0 and x86 with 64 bit
A4 paper, B12 vitamin, H2O
about 3.14159 or 2.71828
call 911 or 112
a 50% share of 1000
section 3.2.1 and 4.5
room 101-B floor 7
isbn 978-3-16-148410-0 book
score 21-19 and 3-2
lines 100 200 300 400
values 12 345 678 901
code 90210 or 10115
it is 7 8 9 10 11
temperature -12 to 30
track 1Z999AA10123456784 on
line14 and file_2023.txt
route 66 to 101
10,000 20,000 30,000 rows
user123 and abc99
https://example.org/a/123 page
@handle and @user99 said
meet @ 5 pm
""".strip().split("\n")
