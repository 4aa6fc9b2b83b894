"""The default polarity lexicon, written for this package.

Polarities are multiples of a quarter, so their sums are exact in binary and a mean does not
depend on the order of the words.
"""

# Polarity -> words.
WORDS_BY_POLARITY = {
    1.0: "best brilliant excellent magnificent masterpiece outstanding perfect superb",
    0.75: "amazing awesome beautiful delightful fantastic great impressive incredible "
    "lovely marvelous stunning wonderful",
    0.5: "charming clever compelling enjoyable enjoyed entertaining fun funny good "
    "gripping happy heartfelt hilarious interesting likable love loved moving "
    "pleasant powerful recommend refreshing touching witty",
    0.25: "decent easy fine fresh nice original solid sweet true watchable worth",
    -0.25: "average cheap cliched confusing odd overlong predictable slow strange uneven",
    -0.5: "annoying bad boring disappointed disappointing dull flat forgettable lame "
    "mediocre mess poor poorly ridiculous sad shallow silly tedious ugly weak wrong",
    -0.75: "dreadful fails hate hated idiotic insulting nonsense painful pathetic "
    "pointless stupid unwatchable waste",
    -1.0: "abysmal appalling atrocious awful disgusting horrible terrible worst worthless",
}

LEXICON = {
    word: polarity for polarity, words in WORDS_BY_POLARITY.items() for word in words.split()
}

# Phrases -> polarity. They count instead of the single words inside them.
PHRASES_BY_POLARITY = {
    1.0: "must see, work of art, second to none, tour de force, one of the best",
    0.75: "edge of my seat, highly recommend, well worth, blown away, top notch, stands out",
    0.5: "worth watching, well done, laugh out loud, well acted, pleasantly surprised, holds up",
    0.25: "not bad, easy on the eye, guilty pleasure",
    -0.25: "so so, nothing special, too long, hit and miss",
    -0.5: "fell flat, let down, falls short, lost interest, not worth, goes nowhere, could care less",
    -0.75: "waste of time, waste of money, fell asleep, walked out, makes no sense, piece of junk",
    -1.0: "one of the worst, worst movie ever, worst film ever, so bad",
}
PHRASES = {
    phrase: polarity
    for polarity, phrases in PHRASES_BY_POLARITY.items()
    for phrase in phrases.split(", ")
}

# Words, without apostrophes, that turn a phrase behind them round.
NEGATIONS = (
    "not no never neither nor without hardly barely cannot cant dont doesnt didnt isnt wasnt arent "
    "werent wont wouldnt couldnt shouldnt hasnt havent hadnt aint"
).split()
