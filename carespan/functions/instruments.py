"""Questionnaire definitions: scales, question texts, score tables and assessment names."""

from __future__ import annotations

import json

# Question texts of every instrument. Single-scale instruments use 'Total'.
# Trailing spaces in some texts are part of the stored question.
QUESTIONS: dict[str, dict[str, list[str]]] = {
    "PROMIS": {
        "Anxiety": [
            "1. I felt fearful... ",
            "2. I found it hard to focus on anything other than my anxiety...",
            "3. My worries overwhelmed me...",
            "4. I felt uneasy...",
        ],
        "Depression": [
            "1. I felt worthless...",
            "2. I felt helpless...",
            "3. I felt depressed...",
            "4. I felt hopeless...",
        ],
        "Emotional": [
            "1. I have someone who will listen to me when I need to talk",
            "2. I have someone to confide in or talk to about myself or my problems",
            "3. I have someone who makes me feel appreciated",
            "4. I have someone to talk with when I have a bad day",
        ],
        "Informational": [
            "1. I have someone to give me good advice about a crisis if I need it",
            "2. I have someone to turn to for suggestions about how to deal with a problem",
            "3. I have someone to give me information if I need it",
            "4. I get useful advice about important things in my life",
        ],
        "Instrumental": [
            "1. Do you have someone to help you if you are confined to bed?",
            "2. Do you have someone to take you to the doctor if you need it?",
            "3. Do you have someone to help you with your daily chores if you are sick?",
            "4. Do you have someone to run errands if you need it?",
        ],
        "Social": [
            "1. I have trouble doing all my regular leisure activities with others",
            "2. I have trouble doing all the family activities that I want to",
            "3. I have trouble doing all my usual work (include work at home)",
            "4. I have trouble doing all the activities with friends that I want to do",
        ],
    },
    "CHAOS": {
        "Total": [
            "1. I have a regular morning routine",
            "2. You can't hear yourself think in our home",
            "3. It's a real zoo in our home",
            "4. We are usually able to stay on top of things",
            "5. There is usually a television turned on somewhere in our home",
            "6. The atmosphere in our house is calm ",
        ]
    },
    "ACT": {
        "Total": [
            "1. In the past 4 weeks, how much time did your/your child's asthma keep you/him or her from getting as much done at work, school or home?",
            "2. During the past 4 weeks, how often have you/your child had shortness of breath?",
            "3. During the past 4 weeks, how often did you/your child's asthma symptoms (wheezing, coughing, shortness of breath, chest tightness or pain) wake you/your child up at night or earlier than usual in the morning?",
            "4. During the past 4 weeks, how often have you/your child used your/your child's rescue inhaler or nebulizer machine (such as albuterol)?",
            "5. How would you rate your/your child's asthma control during the past 4 weeks?",
        ]
    },
    "Edinburgh": {
        "Total": [
            "1. I have been able to laugh and see the funny side of things",
            "2. I have looked forward with enjoyment to things",
            "3. I have blamed myself unnecessarily when things went wrong",
            "4. I have been anxious or worried for no good reason",
            "5. I have felt scared or panicky for no very good reason",
            "6. Things have been getting on top of me",
            "7. I have been so unhappy that I have had difficulty sleeping",
            "8. I have felt sad or miserable",
            "9. I have been so unhappy that I have been crying",
            "10. The thought of harming myself has occurred to me",
        ]
    },
    "PSC": {
        "Attention Problems": [
            "6. Fidgety, unable to sit still",
            "10. Acts as if driven by a motor",
            "7. Daydreams too much",
            "8. Distracted easily",
            "9. Has trouble concentrating",
        ],
        "Internalizing Problems": [
            "1. Feels sad, unhappy",
            "2. Feels hopeless",
            "3. Is down on self",
            "4. Worries a lot",
            "5. Seems to be having less fun",
        ],
        "Externalizing Problems": [
            "11. Fights with other children",
            "12. Does not listen to rules",
            "13. Does not understand other people's feelings",
            "14. Teases others",
            "15. Blames others for his/her troubles",
            "16. Refuses to share",
            "17. Takes things that do not belong to him/her",
        ],
    },
    "PHQ9": {
        "Total": [
            "1. Little interest or pleasure in doing things?",
            "2. Feeling down, depressed or hopeless?",
            "3. Trouble falling asleep, staying asleep, or sleeping too much? [PHQ9]",
            "4. Feeling tired, or having little energy?",
            "5. Poor appetite or overeating?",
            "6. Feeling bad about yourself - or feeling that you are a failure, or that you have let yourself or your family down?",
            "7. Trouble concentrating on things, such as reading the newspaper or watching television?",
            "8. Moving or speaking so slowly that other people could have noticed? Or the opposite - being so fidgety or restless that you have been moving around a lot more than usual? [PHQ9]",
            "9. Thoughts that you would be better off dead, or of hurting yourself in some way?",
        ]
    },
    "PHQA": {
        "Total": [
            "1. Feeling down, depressed, irritable or hopeless?",
            "2. Little interest or pleasure in doing things?",
            "3. Trouble falling asleep, staying asleep, or sleeping too much?",
            "4. Poor appetite, weight loss or overeating?",
            "5. Feeling tired, or having little energy?",
            "6. Feeling bad about yourself - or feeling that you are a failure, or that you have let yourself or your family down?",
            "7. Trouble concentrating on things like school work, reading or watching TV?",
            "8. Moving or speaking so slowly that other people could have noticed? OR...Being so fidgety or restless that you were moving around a lot more than usual?",
            "9. Thoughts that you would be better off dead, or of hurting yourself in some way?",
            "10. Has there been a time in the past month when you have had serious thoughts of ending your life?",
            "11. Have you EVER, in your whole life, tried to kill yourself or made a suicide attempt?",
        ]
    },
    "MHSParent": {
        "Total": [
            "1. Are you actively receiving treatment from a mental health professional currently?",
            "2. Do you have symptoms of mania (feeling high or very happy) or psychosis (strange experiences like hearing things or seeing things that other people didn't)?",
            "3. Have you ever been diagnosed with MDD or Bipolar disorder?",
            "4. Do you have a drug or alcohol problem? ",
        ]
    },
    "MHSPatient": {
        "Total": [
            "1. Do you/your child have a disability or autism?",
            "2. Are you/Is your child actively receiving treatment from a mental health professional currently?",
            "3. Do you/ your child have symptoms of mania (feeling high or very happy) or psychosis (strange experiences like hearing things or seeing things that other people didn't)?",
            "4. Have you/your child ever been diagnosed with MDD or Bipolar disorder?",
            "5. Do you/your child have a drug or alcohol problem? ",
        ]
    },
}

# T-score of each raw PROMIS sum from 4 to 20.
T_SCORES = {
    "Anxiety": [40.3, 48.0, 51.2, 53.7, 55.8, 57.7, 59.5, 61.4, 63.4, 65.3, 67.3, 69.3, 71.2, 73.3, 75.4, 77.9, 81.6],
    "Depression": [41.0, 49.0, 51.8, 53.9, 55.7, 57.3, 58.9, 60.5, 62.2, 63.9, 65.7, 67.5, 69.4, 71.2, 73.3, 75.7, 79.4],
    "Emotional": [25.7, 29.9, 32.1, 34.0, 35.7, 37.3, 38.9, 40.5, 42.1, 43.7, 45.4, 47.2, 49.0, 50.8, 53.0, 55.6, 62.0],
    "Informational": [25.6, 29.8, 32.2, 34.2, 36.1, 37.9, 39.8, 41.8, 43.9, 46.0, 48.1, 50.3, 52.4, 54.7, 57.1, 60.1, 65.6],
    "Instrumental": [29.3, 33.9, 35.9, 37.6, 39.1, 40.5, 41.8, 43.1, 44.5, 45.9, 47.3, 48.9, 50.5, 52.3, 54.4, 57.1, 63.3],
    "Social": [27.5, 31.8, 34.0, 35.7, 37.3, 38.8, 40.5, 42.3, 44.2, 46.2, 48.1, 50.0, 51.9, 53.7, 55.8, 58.3, 64.2],
}
LOWEST_RAW = 4

# Assessment name of each instrument's sequences.
ASSESSMENTS = [
    ("PROMIS", "baseline", "Tier 2 PROMIS Tool"),
    ("PROMIS", "6mo", "Tier 2 PROMIS Tool - 6 Month"),
    ("PROMIS", "12mo", "Tier 2 PROMIS Tool - 12 Month"),
    ("PROMIS", "18mo", "Tier 2 PROMIS Tool - 18 Month"),
    ("PSC", "baseline", "Tier 2 Pediatric Symptom Checklist (PSC-17) Caregiver"),
    ("PSC", "6mo", "Tier 2 Pediatric Symptom Checklist (PSC-17) Caregiver - 6 Month"),
    ("PSC", "12mo", "Tier 2 Pediatric Symptom Checklist (PSC-17) Caregiver - 12 Month"),
    ("PHQA", "baseline", "Tier 3 PHQ-A Caregiver Report"),
    ("PHQA", "6mo", "Tier 3 PHQ-A Caregiver Report - 6 Month"),
    ("PHQA", "12mo", "Tier 3 PHQ-A Caregiver Report - 12 Month"),
    ("PHQ9", "baseline", "Tier 3 PHQ9 Adult or Caregiver"),
    ("PHQ9", "6mo", "Tier 3 PHQ9 Adult or Caregiver - 6 Month"),
    ("PHQ9", "12mo", "Tier 3 PHQ9 Adult or Caregiver - 12 Month"),
    ("ACT", "baseline", "Tier 2 Asthma Control Test (ACT)"),
    ("Edinburgh", "baseline", "Tier 2 Edinburgh (Post-Partum Depression)"),
    ("MHSPatient", "baseline", "Tier 3 Patient Mental Health Screening"),
    ("MHSParent", "baseline", "Tier 3 Parent Mental Health Screening"),
    ("CHAOS", "baseline", "Tier 2 PROMIS Tool"),
    ("CHAOS", "6mo", "Tier 2 PROMIS Tool - 6 Month"),
    ("CHAOS", "12mo", "Tier 2 PROMIS Tool - 12 Month"),
]

STRICT_INSTRUMENTS = ("PROMIS",)


def scale_rows() -> list[tuple[str, str, str, bool]]:
    """(Instrument, Scale, QuestionText, Strict) for every question."""
    return [
        (instrument, scale, question, instrument in STRICT_INSTRUMENTS)
        for instrument, scales in QUESTIONS.items()
        for scale, questions in scales.items()
        for question in questions
    ]


def scale_sizes(instrument: str) -> dict[str, int]:
    return {scale: len(questions) for scale, questions in QUESTIONS[instrument].items()}


def config_json() -> str:
    """The definitions in the questionnaire configuration format."""
    document = {}
    for instrument, scales in QUESTIONS.items():
        if list(scales) == ["Total"]:
            document[instrument] = {"Clean": scales["Total"]}
        else:
            document[instrument] = {s: {"ScoreCol": f"{s} Score", "Clean": q} for s, q in scales.items()}
    return json.dumps(document)
