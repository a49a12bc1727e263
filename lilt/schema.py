"""Constants, vocabularies, aliases and field specifications that must be as they are for right results."""

from __future__ import annotations

from dataclasses import dataclass

#: Signal: samples a second, samples between frames, samples of a pitch and of an energy frame, least amplitude.
SAMPLE_RATE, HOP, PITCH_FRAME, ENERGY_FRAME, EPS = 16_000, 160, 1024, 400, 1e-10
HOP_S = HOP / SAMPLE_RATE
#: Pitch range in Hz.
F0_FLOOR, F0_CEILING = 55.0, 500.0
#: Voice activity: dB below the loud level, above the floor, range that makes the floor count, least dB below the loud level.
VAD_TOP, VAD_MARGIN, VAD_MIN_RANGE, VAD_MIN_TOP = 35.0, 6.0, 20.0, 15.0
#: Frames of the shortest speech run and of the shortest pause.
MIN_SPEECH_FRAMES, MIN_GAP_FRAMES = 5, 6
#: Octave repairs: least local gain in semitones and kernel; global deviation and tolerance in semitones.
LOCAL_GAIN, LOCAL_KERNEL, GLOBAL_DEVIATION, GLOBAL_TOLERANCE = 6.0, 9, 9.0, 6.0
#: Second pitch pass: range around the median, least frames, least ratio of the range.
ADAPT_LOW, ADAPT_HIGH, ADAPT_FRAMES, ADAPT_RATIO = 0.60, 2.00, 10, 2.0
#: Reliable pitch: least voiced frames and share of speech.
RELIABLE_FRAMES, RELIABLE_SHARE = 25, 0.20
#: Contour: flat and expressive range, least rise or fall, least turn (semitones), turn position, least gain in R squared.
FLAT_RANGE, EXPRESSIVE_RANGE, MIN_DELTA, MIN_TURN, TURN_FROM, TURN_TO, MIN_GAIN = 3.0, 9.0, 2.0, 2.0, 0.25, 0.75, 0.05
#: Contour: least voiced seconds for dynamics and for shape, frames beyond which a gap is a long pause, least confidence.
MIN_DYNAMICS_S, MIN_SHAPE_S, PAUSE_FRAMES, MIN_CONFIDENCE = 0.25, 0.50, 30, 0.15
#: Calibration: percentiles of the cuts, least group size.
PERCENTILES, MIN_GROUP = (100 / 3, 200 / 3), 50
#: Keys of records without a dataset and without a gender.
ALL, UNKNOWN = "__all__", "unknown"
#: Longest audio for speaker models, years at model output 1.
SPEAKER_SECONDS, AGE_SCALE = 15.0, 100.0

GENDERS = ("Female", "Male", "Child")
#: Upper age bound (exclusive) and its label; the last has none.
AGE_LEVELS = ((13, "Child"), (20, "Teenager"), (35, "Young Adult"), (60, "Middle-aged"), (None, "Elderly"))
INTONATIONS = ("rising", "falling", "rising-falling", "falling-rising", "flat", "expressive", "uncertain", "too_short")
#: Fields whose labels the report counts.
REPORT_FIELDS = ("pitch_level", "energy_level", "speed_level", "intonation", "contour_shape", "contour_dynamics", "gender", "age_level")


@dataclass(frozen=True)
class Feature:
    """A measure, the label made from it, its three values, and the column that splits its groups further."""

    measure: str
    label: str
    values: tuple[str, str, str]
    extra: str | None = None


FEATURES = (
    Feature("f0_median_hz", "pitch_level", ("low", "normal", "high"), "gender"),
    Feature("energy_dbfs", "energy_level", ("low", "normal", "high")),
    Feature("articulation_rate_pps", "speed_level", ("slow", "normal", "fast")),
)

#: Prompt placeholders and the fields that may hold each, best first.
ALIASES = {
    "groundtruth_emotion": ("emotion", "gt", "groundtruth_emotion", "label"),
    "transcription": ("transcription", "text", "transcript"),
    "speaker_gender": ("gender", "gender_new", "speaker_gender"),
    "speaker_age": ("age_level", "age_group", "speaker_age"),
    "pitch_level": ("pitch_level",),
    "energy_level": ("energy_level",),
    "speed_level": ("speed_level",),
    "intonation_contour": ("intonation", "intonation_contour", "contour_shape"),
    "stressed_word": ("stressed_words", "stress", "stress_words"),
}
#: Placeholders without which a prompt can't be made, and what stands for the others where they are missing.
REQUIRED = ("groundtruth_emotion", "transcription")
DEFAULTS = {"intonation_contour": "uncertain"}
